from tidewater.functions.arrays import explode_type, first_of_type, first_where, merge_record
from tidewater.functions.json_paths import TYPES, cast_counts, cast_metrics, cast_rejects, casting, once, path, project, typed
from tidewater.functions.scalar import (
    abs_diff, blank_to_null, clean_key, config_key, decimal, differs, digits,
    export_quantity, export_unit_price, full_name, hotel_of,
    hours_between, instant, int_or_zero, is_one, iso_date, local_day, map_code,
    micros_between, month_of, only_digits, present, slice_text, starts_with_ci,
    status_of, text_to_utc, unit_price,
)
