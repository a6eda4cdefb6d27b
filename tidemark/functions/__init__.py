from tidemark.functions.envelope import parse_envelope, table_of
from tidemark.functions.images import cast_image, cast_text, flatten_images
from tidemark.functions.money import exact_sum

__all__ = [
    "cast_image",
    "cast_text",
    "exact_sum",
    "flatten_images",
    "parse_envelope",
    "table_of",
]
