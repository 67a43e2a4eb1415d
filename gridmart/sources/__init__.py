from gridmart.sources.landing import (  # noqa: F401
    landing_counts,
    landing_status,
    list_landed,
    require_no_failures,
    scan_with_provenance,
)
from gridmart.sources.registry import (  # noqa: F401
    build_manifest,
    registry,
    year_range,
)
from gridmart.sources.seeds import read_seed  # noqa: F401
from gridmart.sources.staging import flatten, read_columns, record_schema, stage  # noqa: F401
