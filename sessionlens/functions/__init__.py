from sessionlens.functions.columns import (  # noqa: F401
    first_time, flag, last_time, like_any, minutes_between, seconds_between,
    surrogate_key, url_param,
)
from sessionlens.functions.rules import classify, classify_sql  # noqa: F401
