"""Safe casts, surrogate keys, code decoding and bulk renames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The surrogate-key convention (md5 of the string values
# joined by '-', NULL replaced by this token) used by the common
# generate_surrogate_key macro, so keys equal those of the SQL models.
SURROGATE_NULL_TOKEN = "_dbt_utils_surrogate_key_null_"
SURROGATE_SEPARATOR = "-"

# Payment-type code -> label, anything else 'EMPTY'.
PAYMENT_TYPE_LABELS = {
    1: "Credit card",
    2: "Cash",
    3: "No charge",
    4: "Dispute",
    5: "Unknown",
    6: "Voided trip",
}
PAYMENT_TYPE_DEFAULT = "EMPTY"


def safe_cast(c: Column, type_: str) -> Column:
    """SAFE_CAST: NULL instead of an error when the value does not fit."""
    return c.try_cast(type_)


def surrogate_key(*cols: str | Column) -> Column:
    parts = [
        F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(SURROGATE_NULL_TOKEN))
        for c in cols
    ]
    return F.md5(F.concat_ws(SURROGATE_SEPARATOR, *parts))


def decode(c: Column, mapping: dict, default: str | None = None, key_type: str = "int") -> Column:
    """CASE over a safely cast code; unmatched (and NULL) codes get ``default``."""
    key = c.try_cast(key_type)
    out = None
    for k, label in mapping.items():
        out = (F.when(key == F.lit(k), F.lit(label)) if out is None else out.when(key == F.lit(k), F.lit(label)))
    return out.otherwise(F.lit(default)) if out is not None else F.lit(default)


def payment_type_description(c: Column) -> Column:
    return decode(c, PAYMENT_TYPE_LABELS, PAYMENT_TYPE_DEFAULT)


def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rename many columns in one Project; unknown names are ignored."""
    return df.withColumnsRenamed(mapping)
