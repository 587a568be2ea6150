"""Name hygiene on columns, values and path parts."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed pattern: characters that may not stay in a name.
_UNSAFE = r"[ ,()\[\]<>]"


def clean_name(name: str) -> str:
    """Name rule for one (schema-level) string."""
    return re.sub("_+", "_", re.sub(_UNSAFE, "_", name.strip())).strip("_")


def clean_value(value: Column) -> Column:
    """The same rule on a string column."""
    return F.btrim(F.regexp_replace(F.regexp_replace(F.trim(value), _UNSAFE, "_"), "_+", "_"), F.lit("_"))


def slugify(value: Column) -> Column:
    """Lower-case path-safe form: only letters, digits and single underscores."""
    spaced = F.regexp_replace(F.lower(F.trim(value)), r"[^a-z0-9]", "_")
    return F.btrim(F.regexp_replace(spaced, "_+", "_"), F.lit("_"))


def sanitize_columns(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """Rename every unsafe column; also returns old name to new name."""
    names = {c: clean_name(c) for c in df.columns}
    if len(set(names.values())) < len(names):
        raise ValueError("two columns share one cleaned name")
    return df.withColumnsRenamed(names), names


def sanitize_values(df: DataFrame, column: str) -> DataFrame:
    """Clean the values of one string column; other types pass unchanged."""
    if dict(df.dtypes)[column] != "string":
        return df
    return df.withColumn(column, clean_value(F.col(column)))
