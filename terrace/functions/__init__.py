from terrace.functions.columns import (  # noqa: F401
    DATE_FORMATS,
    HOLDER_DOC_LABELS,
    HOLDER_DOC_OTHER,
    MEMBER_DOC_LABELS,
    MEMBER_DOC_OTHER,
    join_name,
    label_code,
    last_digit,
    pad_digits,
    parse_date,
    stamp_date,
    strip_chars,
    strip_space,
    whole_number_via_decimal,
    whole_number_via_integer,
)
