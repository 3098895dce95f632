from ledgerloom.functions.scalars import (  # noqa: F401
    blank_to_null,
    calendar_columns,
    code_before_comma,
    contains_tag,
    exact_sum,
    guarded_ratio,
    in_period,
    month_index,
    month_index_of,
    nan_to_null,
    non_integral,
    normalize_header,
    parse_date,
    parse_money,
    parse_number,
    period_bounds,
    period_from_name,
    previous_periods,
    squash_text,
    valid_key,
)
