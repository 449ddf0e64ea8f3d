from tidewater.operators.aggregates import (
    count_distinct_tuple, count_where, coverage, main_value, mart, nest, sum_decimal,
    sum_where, table_counts,
)
from tidewater.operators.filters import (
    by_key, changed_between, filter_sales, in_period, last_days, missing_any, not_future,
    since, since_any, starting_from, where_if, where_in, where_nonzero, where_path, where_present,
)
from tidewater.operators.incremental import (
    bounds, calendar, date_chunks, gone, lookback, missing_days, work_list,
)
from tidewater.operators.joins import (
    left_joins, left_lookup, left_lookup_many, lookup_first, match_inner, match_left, missing_detail, one_per_key,
    prefer, reconcile, resolve, with_exists, without,
)
from tidewater.operators.ordering import sort, top
from tidewater.operators.windows import with_next, work_intervals
