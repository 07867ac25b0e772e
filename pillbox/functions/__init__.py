from pillbox.functions.casts import decode, payment_type_description, rename, safe_cast, surrogate_key
from pillbox.functions.strings import first_phone, normalise, normalise_strings

__all__ = [
    "decode",
    "first_phone",
    "normalise",
    "normalise_strings",
    "payment_type_description",
    "rename",
    "safe_cast",
    "surrogate_key",
]
