from gridmart.quality.checks import (  # noqa: F401
    accepted_values,
    count_violations,
    duplicate_keys,
    not_null,
    orphans,
    rule,
)
from gridmart.quality.contracts import CONTRACTS, Contract  # noqa: F401
from gridmart.quality.runner import check_model, failed, run_checks  # noqa: F401
