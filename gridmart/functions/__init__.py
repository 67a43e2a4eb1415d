from gridmart.functions.columns import (  # noqa: F401
    flag,
    is_no_play,
    is_real_play,
    lenient_double,
    nan_to_null,
)
from gridmart.functions.labels import (  # noqa: F401
    opponent_of,
    play_success,
    side_of_code,
    side_of_franchise,
)
