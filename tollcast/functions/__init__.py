from .calendar import (BIN_MINUTES, HOLIDAY_RANGES, WEEKDAYS, bucket_date,  # noqa: F401
                       calendar_parts, dummies, holiday_dates, hour_bucket, is_holiday,
                       weekday_name)
from .lists import explode_list, has_many, split_list  # noqa: F401
from .timefns import (TS_FORMAT, bin_start, fmt_ts, parse_date, parse_ts,  # noqa: F401
                      parse_window_start, shift, window_label)
