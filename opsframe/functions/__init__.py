"""Column functions and name helpers."""

from opsframe.functions.json_text import (
    as_json_text,
    base64_json,
    encode_base64,
    float_or_null,
    infer_json_schema,
    is_json,
    nested_to_string,
    numeric_hook,
    numeric_struct,
    parse_json_line,
    parse_json_numeric,
)
from opsframe.functions.lists import explode_once, flatten_lists
from opsframe.functions.text import form_encode, form_field, form_quote, strip
from opsframe.functions.times import from_micros, from_millis, to_millis

__all__ = [
    "as_json_text",
    "base64_json",
    "encode_base64",
    "explode_once",
    "flatten_lists",
    "float_or_null",
    "form_encode",
    "form_field",
    "form_quote",
    "from_micros",
    "from_millis",
    "infer_json_schema",
    "is_json",
    "nested_to_string",
    "numeric_hook",
    "numeric_struct",
    "parse_json_line",
    "parse_json_numeric",
    "strip",
    "to_millis",
]
