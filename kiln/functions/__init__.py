from kiln.functions.exprs import (  # noqa: F401
    RIDES_DATE_FORMATS, USERS_DATE_FORMATS, blank_to_null, fill_text, is_blank, parse_date,
    round_half_even, strip_ws, to_int_half_even, to_number, truncate_int,
)
