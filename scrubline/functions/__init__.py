from scrubline.functions.names import snake_case, snake_columns
from scrubline.functions.parsing import is_numeric_text, parse_int, parse_timestamp

__all__ = [
    "is_numeric_text",
    "parse_int",
    "parse_timestamp",
    "snake_case",
    "snake_columns",
]
