from spindle.functions.text import (  # noqa: F401
    java_split, lines_of, tokenize, strip_quotes, WHITESPACE_CLASS,
)
from spindle.functions.scalars import (  # noqa: F401
    binarize_label, int_div, parse_sensor_line, is_uuid, json_field, to_bytes, from_bytes,
)
