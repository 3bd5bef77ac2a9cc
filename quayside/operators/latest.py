"""C1 ``latest_per_key`` — one row per key, the first by a descending order.

Planned as ``row_number() = 1`` over a window: Spark inserts a partial
``WindowGroupLimit`` before the shuffle, so every map task already keeps only
its local top row per key and a hot key ships at most one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import ColumnOrName, c

_RN = "__rn"


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column],
                   tie_break: Sequence[ColumnOrName] = (), keep: Column | None = None) -> DataFrame:
    """Keep the first row per ``keys`` by ``order`` then ``tie_break``.

    ``order`` is given explicitly (e.g. ``[F.col("DAY").desc()]``; ``desc`` puts
    NULLs last).  ``tie_break`` must make the order total — ties left open give
    a different row on every run (Q7).  ``keep`` is applied *after* the
    deduplication: a key whose latest version is deleted vanishes even when an
    older version is not deleted (F17).
    """
    w = Window.partitionBy(*keys).orderBy(*order, *[c(t) for t in tie_break])
    out = df.withColumn(_RN, F.row_number().over(w)).where(F.col(_RN) == 1).drop(_RN)
    return out.where(keep) if keep is not None else out
