from gridmart.sinks.marts import save_mart  # noqa: F401
from gridmart.sinks.raw import load_landed, replace_by_source_file  # noqa: F401
from gridmart.sinks.results import (  # noqa: F401
    METRICS_SCHEMA,
    PREDICTIONS_SCHEMA,
    append_result,
    create_result_tables,
)
