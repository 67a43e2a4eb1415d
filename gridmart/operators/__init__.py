from gridmart.operators.asof import as_of_join  # noqa: F401
from gridmart.operators.codes import normalize_codes, small_side  # noqa: F401
from gridmart.operators.intervals import overlap_join  # noqa: F401
from gridmart.operators.members import add_missing_members, without_parent  # noqa: F401
from gridmart.operators.picks import (  # noqa: F401
    latest_per_key,
    pick_order,
    primary_by_count,
)
from gridmart.operators.quantiles import exact_medians, modes, value_counts  # noqa: F401
from gridmart.operators.roles import unpivot_roles  # noqa: F401
from gridmart.operators.rollup import conditional_rollup  # noqa: F401
from gridmart.operators.scan import running  # noqa: F401
