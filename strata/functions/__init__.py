"""Column expressions: labels, decimal scaling, casts, JSON codec."""

from strata.functions.casts import cast_by_name, normalize_nan
from strata.functions.decimals import scale_decimal
from strata.functions.json import ENCODE_OPTIONS, decode_value, encode_row
from strata.functions.labels import code_to_label

__all__ = [
    "cast_by_name",
    "normalize_nan",
    "scale_decimal",
    "decode_value",
    "encode_row",
    "ENCODE_OPTIONS",
    "code_to_label",
]
