"""Refresh of a materialized aggregate from changes.

``AggregateView`` describes ``SELECT groups, count(*), sum(..), min(..), max(..)
... GROUP BY groups``.  Its stored state has one row per group: the number of
rows, per summed column the sum and the number of present values, per extreme
column the minimum, the maximum and the number of present values.

``refresh`` brings a state up to date from the signed rows of a delta
(``DmlResult.delta``), which are aggregated per group first, so its cost goes
with the changes and the groups, not with the table: counts and sums add up,
and new values widen the extremes.  Only where a row went that held a group's
minimum or maximum is the table read again, for those groups (a semi join).
A group without rows goes.  Sums of doubles would depend on the order of the
changes; sum decimals or integers for exact results.

``MaterializedView`` keeps the states as versions of a published table
(``publish.py``), with the version of the base table that each was made from.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import publish
from .dml import SIGN
from .subqueries import any_row

N = "n_rows"


def _same(groups: Sequence[str], left: str, right: str) -> Column:
    """Equality of the groups, NULL with NULL."""
    cond = F.lit(True)
    for g in groups:
        cond = cond & F.col(f"{left}.{g}").eqNullSafe(F.col(f"{right}.{g}"))
    return cond


@dataclass(frozen=True)
class AggregateView:
    groups: tuple[str, ...]
    sums: tuple[str, ...] = ()
    extremes: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        if not self.groups:
            raise ValueError("a view has at least one group column")

    def build(self, table: DataFrame) -> DataFrame:
        """The state from the whole table."""
        aggs = [F.count(F.lit(1)).alias(N)]
        for c in self.sums:
            aggs += [F.sum(c).alias(f"sum_{c}"), F.count(c).alias(f"sum_n_{c}")]
        for c in self.extremes:
            aggs += [F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}"), F.count(c).alias(f"ext_n_{c}")]
        return table.groupBy(*self.groups).agg(*aggs)

    def _changes(self, delta: DataFrame) -> DataFrame:
        """The delta per group: net counts and sums, the extremes of new and of old values."""
        sign = F.col(SIGN)
        aggs = [F.sum(sign).alias(f"d_{N}")]
        net = lambda c: F.sum(F.when(F.col(c).isNotNull(), sign).otherwise(0))
        for c in self.sums:
            aggs += [F.sum(F.col(c) * sign).alias(f"d_sum_{c}"), net(c).alias(f"d_sum_n_{c}")]
        for c in self.extremes:
            new, old = (F.when(sign > 0, F.col(c)), F.when(sign < 0, F.col(c)))
            aggs += [F.min(new).alias(f"new_min_{c}"), F.max(new).alias(f"new_max_{c}"), F.min(old).alias(f"old_min_{c}"),
                     F.max(old).alias(f"old_max_{c}"), net(c).alias(f"d_ext_n_{c}")]
        return delta.groupBy(*self.groups).agg(*aggs)

    def refresh(self, state: DataFrame, delta: DataFrame, table: DataFrame) -> DataFrame:
        """The state after the delta; ``table`` is the table after it, read only where an extreme went."""
        # Both sides have one row per group, so no key is hot.
        both = state.alias("s").join(self._changes(delta).alias("d"), _same(self.groups, "s", "d"), "full")
        num = lambda c: F.coalesce(F.col(c), F.lit(0))
        groups = [F.when(F.col(f"s.{N}").isNotNull(), F.col(f"s.{g}")).otherwise(F.col(f"d.{g}")).alias(g) for g in self.groups]
        out, lost = [(num(N) + num(f"d_{N}")).cast("long").alias(N)], F.lit(False)
        for c in self.sums:
            kind = state.schema[f"sum_{c}"].dataType
            n = (num(f"sum_n_{c}") + num(f"d_sum_n_{c}")).cast("long")
            total = (F.coalesce(F.col(f"sum_{c}"), F.lit(0)) + F.coalesce(F.col(f"d_sum_{c}"), F.lit(0))).cast(kind)
            out += [F.when(n > 0, total).alias(f"sum_{c}"), n.alias(f"sum_n_{c}")]
        for c in self.extremes:
            n = (num(f"ext_n_{c}") + num(f"d_ext_n_{c}")).cast("long")
            low, high = F.least(f"min_{c}", f"new_min_{c}"), F.greatest(f"max_{c}", f"new_max_{c}")
            # A row went that held the extreme, and nothing new reaches as far.
            gone = ((F.col(f"old_min_{c}") <= low) | (F.col(f"old_max_{c}") >= high)) & (n > 0)
            lost = lost | F.coalesce(gone, F.lit(False))
            out += [F.when(n > 0, low).alias(f"min_{c}"), F.when(n > 0, high).alias(f"max_{c}"), n.alias(f"ext_n_{c}")]
        merged = both.select(*groups, *out, lost.alias("_lost")).where(F.col(N) > 0)
        if not self.extremes:
            return merged.drop("_lost")
        again = merged.where("_lost").select(*self.groups).alias("a")
        rebuilt = self.build(table.alias("t").join(again, _same(self.groups, "t", "a"), "left_semi"))
        return merged.where(~F.col("_lost")).drop("_lost").unionByName(rebuilt.select(*state.columns))


@dataclass
class MaterializedView:
    """An aggregate of a published table, stored as versions of its own."""

    view: AggregateView
    source: str
    base: str

    def create(self, spark) -> int:
        """Build from the newest version of the source; returns that version."""
        version = publish.current_version(spark, self.source)
        return self._store(spark, self.view.build(publish.read_version(spark, self.source, version)), version)

    def _store(self, spark, state: DataFrame, version: int) -> int:
        made = state.withColumn("_of", F.lit(version).cast("long"))
        publish.begin(spark, self.base).replace(made)
        return version

    def _state(self, spark) -> DataFrame:
        return publish.read_current(spark, self.base)

    def read(self, spark) -> DataFrame:
        return self._state(spark).drop("_of")

    def version(self, spark) -> int:
        """The source's version that the view shows (0 for one without any group)."""
        return self._state(spark).agg(F.coalesce(F.max("_of"), F.lit(0))).first()[0]

    def refresh(self, spark) -> int:
        """Bring the view to the source's newest version from the changes since its own; returns that version.

        A version that replaced the whole table leaves no changes: the view is then built anew.
        """
        at, head = self.version(spark), publish.current_version(spark, self.source)
        if at == head:
            return head
        table = publish.read_version(spark, self.source, head)
        log = f"{self.source.rstrip('/')}/_log"
        entries = [publish.log_entry(spark, log, v) for v in range(at + 1, head + 1)]
        if not at or any(e["changes"] is None for e in entries):
            return self._store(spark, self.view.build(table), head)
        delta = None
        for e in entries:
            part = spark.read.parquet(f"{self.source}/{e['changes']}")
            delta = part if delta is None else delta.unionByName(part)
        return self._store(spark, self.view.refresh(self.read(spark), delta, table), head)


def equal(view: AggregateView, one: DataFrame, other: DataFrame) -> bool:
    """Whether two states are the same, NULL groups included."""
    columns = one.columns
    return not any_row(one.exceptAll(other.select(*columns))) and not any_row(other.select(*columns).exceptAll(one))
