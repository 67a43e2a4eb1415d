"""Play-by-play sports analytics as Spark jobs: landing, star schema, checks, baseline model."""
