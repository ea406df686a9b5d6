from daycast.functions.time import (  # noqa: F401
    cutoff_time, day_of_week0, epoch_day, hour_floor, month_key, month_start,
    range_text, shift_days, to_ntz, week_label, week_start,
)
from daycast.functions.transforms import (  # noqa: F401
    abs_error, asinh_target, clip, sinh_inverse, win_flag,
)
