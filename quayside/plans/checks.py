"""Contract checks in a job's own pass: counts that Spark takes while the result is written (``DataFrame.observe``).

``JobReport`` goes through a job: operators hand it the rows after each join
with a lookup and the casts of dirty columns.  After the write and before the
result replaces the old one, ``verify`` compares the counts.  No extra job runs
unless a join has multiplied rows; then the lookup in question is checked exactly, since a
lost executor can make Spark count a recomputed task twice.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..sources.readers import assert_unique


@dataclass
class JobReport:
    """``rows``: after each step; ``dirty``: by column, values that were there and didn't convert (NULL in the result)."""

    rows: dict[str, int] = field(default_factory=dict)
    dirty: dict[str, int] = field(default_factory=dict)
    _steps: list[tuple[str, Observation, DataFrame | None, Sequence[str]]] = field(default_factory=list, repr=False)
    _casts: list[Observation] = field(default_factory=list, repr=False)

    def step(self, name: str, df: DataFrame, lookup: DataFrame | None = None, keys: Sequence[str] = ()) -> DataFrame:
        """``df``, whose rows are counted; the step joined ``lookup``, which must be unique on ``keys``."""
        seen = Observation(f"{name}-{len(self._steps)}")
        self._steps.append((name, seen, lookup, keys))
        return df.observe(seen, F.count(F.lit(1)).alias("rows"))

    def casts(self, df: DataFrame, made: dict[str, tuple[Column, Column]]) -> DataFrame:
        """``df``; for each name, rows whose first column has a value and whose second, its cast, has none are counted."""
        if not made:
            return df
        seen = Observation(f"casts-{len(self._casts)}")
        self._casts.append(seen)
        return df.observe(seen, *[F.count_if(raw.isNotNull() & cast.isNull()).alias(n) for n, (raw, cast) in made.items()])

    def verify(self) -> None:
        """Fill in the counts, and raise if a lookup repeated a key and multiplied rows.  Call it after the action."""
        for seen in self._casts:
            for name, n in seen.get.items():
                self.dirty[name] = self.dirty.get(name, 0) + n
        before = None
        for name, seen, lookup, keys in self._steps:
            now = self.rows[name] = seen.get.get("rows", 0)
            if lookup is not None and before is not None and now > before:
                assert_unique(lookup, keys, name)
            before = now
