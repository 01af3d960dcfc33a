from .dates import clean_excel_date, excel_date, month_label, month_start, normalise_date_text
from .numbers import (
    exact_ratio,
    fixed_text,
    floor_int,
    lenient_decimal,
    money,
    rate,
    ratio_or_zero,
    repair_number,
    safe_ratio,
)
from .text import (
    blank_to_null,
    display_name,
    json_object_text,
    json_text_map,
    key_display,
    key_text,
    payload_text,
    strip,
)

__all__ = [
    "blank_to_null",
    "display_name",
    "clean_excel_date",
    "exact_ratio",
    "excel_date",
    "fixed_text",
    "floor_int",
    "json_object_text",
    "json_text_map",
    "key_display",
    "key_text",
    "lenient_decimal",
    "money",
    "month_label",
    "month_start",
    "normalise_date_text",
    "payload_text",
    "rate",
    "ratio_or_zero",
    "repair_number",
    "safe_ratio",
    "strip",
]
