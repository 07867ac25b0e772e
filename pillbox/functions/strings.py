"""String normalisation (one projection over every string column)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# The tokens that mean "missing", and the separator between
# several phone numbers in one cell (everything from it on is dropped).
MISSING_TOKENS = ["", "null"]
PHONE_SEPARATOR = " Or "


def normalise(c: Column) -> Column:
    """'' and 'null' become NULL, anything else is trimmed.

    The comparison happens *before* the trim, so '  ' becomes '' and
    ' null ' becomes 'null'; both are kept.
    """
    return F.when(c.isin(MISSING_TOKENS), F.lit(None)).otherwise(F.trim(c))


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]


def normalise_strings(df: DataFrame) -> DataFrame:
    """Rewrite all string columns in one ``withColumns`` (one Project)."""
    cols = string_columns(df)
    return df.withColumns({c: normalise(F.col(c)) for c in cols}) if cols else df


def first_phone(c: Column) -> Column:
    """Keep only the first of several phone numbers joined by ' Or '."""
    return F.substring_index(c, PHONE_SEPARATOR, 1)
