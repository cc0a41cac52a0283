"""Key look-ups that are the same plan at every size.

Nothing here measures its input.  Whether a side is broadcast is the optimizer's decision by its
size threshold, and a hot key is split by adaptive execution (``session.DEFAULTS`` turns the skewed
join handling on, also where it costs the next aggregate an exchange).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def with_known_key(df: DataFrame, keys: DataFrame, key: str, flag: str) -> DataFrame:
    """Add ``flag``: is ``key`` found in ``keys``?  Null is never found.  One left join."""
    known = keys.select(key).distinct().withColumn(flag, F.lit(True))
    return df.join(known, key, "left").withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))
