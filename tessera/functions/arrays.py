"""Array functions (ARR1-ARR4, STR10)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.text import normalise_key, split_list


def id_list(text: Column, sep: str = ", ") -> Column:
    """ARR1: ``ARRAY(SELECT SAFE_CAST(x AS INT64) FROM UNNEST(SPLIT(s, ', ')))``.

    Bad elements become NULL elements (kept); a NULL text gives NULL.
    """
    return F.transform(split_list(text, sep), lambda x: x.try_cast("bigint"))


def id_items(df: DataFrame, c: str, sep: str = ", ") -> Column:
    """JN10: ``UNNEST`` of a list of ids that is an array or text, for a ``select``; cast each item afterwards.

    Text is split inside the generator: a list that a projection makes first
    would be made twice, once more in the filter that Spark infers from it.
    """
    text = isinstance(df.schema[c].dataType, T.StringType)
    return F.explode(split_list(F.col(c), sep) if text else F.col(c))


def id_set_text(text: Column) -> Column:
    """JN12 helper: ``REPLACE(s,' ','')`` then the distinct comma-separated
    members, as ``FIND_IN_SET`` sees them (each member counted once)."""
    return F.array_distinct(F.split(F.replace(text, F.lit(" "), F.lit("")), ","))


def normalise_items(arr: Column) -> Column:
    """ARR3: normalise each element (strip/lower/underscore)."""
    return F.transform(arr, normalise_key)


def join_list(arr: Column, sep: str = " -> ") -> Column:
    """STR10: list → string."""
    return F.array_join(arr, sep)
