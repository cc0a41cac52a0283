"""Text columns to declared types."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from bazaarlake.schemas import CORRUPT_COLUMN

MALFORMED = "malformed"


def _typed(column: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.StringType):
        return column
    return column.try_cast(kind)


def apply_types(raw: DataFrame, schema: T.StructType, keep: tuple[str, ...] = ()) -> DataFrame:
    """Cast every column; mark rows holding text that does not fit its type.

    The mark is a column, not a filter, so that the rows reach the quarantine.
    """
    present = set(raw.columns)
    wrong = [
        F.col(f.name).isNotNull() & _typed(F.col(f.name), f.dataType).isNull()
        for f in schema.fields
        if not isinstance(f.dataType, T.StringType)
    ]
    if CORRUPT_COLUMN in present:
        wrong.append(F.col(CORRUPT_COLUMN).isNotNull())
    malformed = F.lit(False)
    for test in wrong:
        malformed = malformed | test
    return raw.select(
        *[_typed(F.col(f.name), f.dataType).alias(f.name) for f in schema.fields],
        *keep,
        malformed.alias(MALFORMED),
    )
