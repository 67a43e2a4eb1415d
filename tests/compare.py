"""Run a query in Spark and its SQL in DuckDB over the same files and compare rows and types."""

from __future__ import annotations

from collections import Counter

import duckdb

TABLES = """region nation customer supplier part orders lineitem events documents embeddings
pages benchmark labels conversations""".split()

# Spark type name -> DuckDB type name
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "boolean": "BOOLEAN",
}


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def difference(df, con, sql: str) -> str | None:
    """None if equal, else a description."""
    rel = con.sql(sql)
    names = sorted(rel.columns)
    if sorted(df.columns) != names:
        return f"columns {sorted(df.columns)} != {names}"
    duck_types = dict(zip(rel.columns, map(str, rel.types)))
    bad = {
        c: (t, duck_types[c]) for c, t in df.dtypes if TYPES.get(t, t) != duck_types[c]
    }
    if bad:
        return f"types {bad}"
    left = Counter(tuple(r) for r in df.select(*names).toArrow().to_pandas(types_mapper=None, date_as_object=True).astype(object).where(lambda x: x.notna(), None).itertuples(index=False, name=None))
    right = Counter(rel.select(*[f'"{n}"' for n in names]).fetchall())
    if left != right:
        return (
            f"rows {sum(left.values())} != {sum(right.values())}; "
            f"only spark {list((left - right).items())[:2]}; only sql {list((right - left).items())[:2]}"
        )
    return None
