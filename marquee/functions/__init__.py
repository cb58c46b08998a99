from marquee.functions.casts import lenient, lenient_double, lenient_int, lenient_long
from marquee.functions.nested import is_corrupt, json_array

__all__ = [
    "is_corrupt",
    "json_array",
    "lenient",
    "lenient_double",
    "lenient_int",
    "lenient_long",
]
