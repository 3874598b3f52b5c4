"""Previous and next row inside a key, without holding a key in one task.

The ordered rows of a hot key are cut into slices of about equal numbers of rows: a sample of the key's
positions, drawn by their hash, is a quantile sketch, and every so many-th of it starts a slice. Rows find
their slice by binary search, so the cut follows the rows however their order values are spread. Any
other key is one slice. ``lag`` and ``lead`` run inside (key, slice); only the edge rows of each
slice travel between slices, as a summary of one row per (key, slice). The result equals the plain
window over the whole key.

``lay_out`` shuffles the rows once by (key, slice). Every later step, windows, slice summaries and
the joins back, works on that partitioning, so Spark reuses the one exchange.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from tidemark.operators.duplicates import keep_last
from tidemark.operators.hotkeys import NAME, HotKeys, hot_names, name_rows
from tidemark.operators.selection import CUTS, quantile_cuts, range_of

SLICE = "_slice"
# Stand-ins that make a nullable key non-null next to its null flag; never visible in results.
_FILLERS = {
    "string": "", "bigint": 0, "int": 0, "smallint": 0, "tinyint": 0, "double": 0.0, "float": 0.0,
    "boolean": False, "date": "1970-01-01", "timestamp": "1970-01-01", "timestamp_ntz": "1970-01-01",
}


def _filler(kind: DataType) -> Column:
    name = kind.simpleString()
    return F.lit(_FILLERS.get(name, 0)).cast(kind)


@dataclass(frozen=True)
class Timeline:
    """Rows of each key in a total order.

    ``order`` tells the rows of a key apart once ``lay_out`` has settled ties. Hot keys are cut where their quantiles
    lie, or by ``slice_by`` if given, which must not decrease along ``order``.
    """

    keys: tuple[str, ...]
    order: tuple[str, ...]
    slice_by: Column | None = None
    hot: HotKeys = HotKeys()

    @property
    def place(self) -> list[str]:
        return [*[f"_key_{k}" for k in self.keys], *[f"_null_{k}" for k in self.keys], SLICE]

    @property
    def inside(self) -> WindowSpec:
        """The ordered rows of one key within one slice."""
        return Window.partitionBy(*self.place).orderBy(*self.order)

    @property
    def across(self) -> WindowSpec:
        """The slices of one key in order, over a summary whose ``_from`` is the first position."""
        return Window.partitionBy(*self.place[: 2 * len(self.keys)]).orderBy("_from")

    def cuts(self, df: DataFrame) -> DataFrame:
        """One row per hot key: its hash and the positions at which its slices start, the first slice's left out."""
        named = name_rows(df, self.keys)
        if self.slice_by is not None:
            return hot_names(named, self.hot).withColumn(CUTS, F.array().cast("array<int>"))
        return quantile_cuts(named, self.keys, self.order, self.hot)

    def mark(self, df: DataFrame, cuts: DataFrame | None = None) -> DataFrame:
        """Replace the keys by non-null place columns, which join and shuffle without null checks."""
        cuts = self.cuts(df) if cuts is None else cuts
        named = name_rows(df, self.keys).join(F.broadcast(cuts), NAME, "left")
        parts = {f"_key_{k}": F.coalesce(k, _filler(df.schema[k].dataType)) for k in self.keys}
        parts |= {f"_null_{k}": F.col(k).isNull() for k in self.keys}
        parts |= {SLICE: self._slice()}
        return named.withColumns(parts).drop(*self.keys, NAME, CUTS)

    def _slice(self) -> Column:
        if self.slice_by is not None:
            # As text, so that any type will do; slices are ordered by the positions in them.
            return F.when(F.col(CUTS).isNotNull(), F.coalesce(F.concat(F.lit("="), self.slice_by.cast("string")), F.lit(""))).otherwise(F.lit(""))
        return range_of(self.order)

    def lay_out(self, df: DataFrame, prefer: Sequence[str], cuts: DataFrame | None = None) -> DataFrame:
        """The one shuffle: rows placed by (key, slice), one row per key and order value.

        Where order values repeat, the largest row by ``prefer`` stays. Copies of one row can only be
        many in a hot key, so a hot key's rows are aggregated first, combining copies before they are
        shuffled; without hot keys that branch is empty and is not run.
        """
        cuts = self.cuts(df) if cuts is None else cuts
        named, names = name_rows(df, self.keys), F.broadcast(cuts.select(NAME))
        hot = keep_last(named.join(names, NAME).drop(NAME), [*self.keys, *self.order], prefer)
        cold = named.join(names, NAME, "left_anti").drop(NAME)
        return self._drop_ties(self.mark(cold.unionByName(hot), cuts).repartition(*self.place), prefer)

    def restore(self, placed: DataFrame) -> DataFrame:
        """Keys back under their names, place columns gone."""
        keys = {k: F.when(~F.col(f"_null_{k}"), F.col(f"_key_{k}")) for k in self.keys}
        return placed.withColumns(keys).drop(*self.place)

    def _drop_ties(self, placed: DataFrame, prefer: Sequence[str]) -> DataFrame:
        inside = Window.partitionBy(*self.place).orderBy(*self.order, *prefer)
        following = F.lead(F.struct(*self.order)).over(inside)
        tied = placed.withColumn("_tied", following.isNotNull() & following.eqNullSafe(F.struct(*self.order)))
        return tied.filter(~F.col("_tied")).drop("_tied")

    def with_neighbour(
        self,
        placed: DataFrame,
        into: str,
        columns: Sequence[str],
        forward: bool,
        edges_from: DataFrame | None = None,
    ) -> DataFrame:
        """Add struct ``into`` with ``columns`` of the row before (or after), NULL at the key's end.

        ``edges_from`` may name a cheaper marked frame with the same rows and order values for the
        slice summary.
        """
        packed = F.struct(*columns)
        step = F.lead if forward else F.lag
        edges = self._slice_edges(placed if edges_from is None else edges_from, packed, forward)
        edges = edges.withColumn("_beyond", step("_edge").over(self.across))
        edges = edges.filter(F.col("_beyond").isNotNull()).select(*self.place, "_beyond")
        return (
            placed.withColumn(into, step(packed).over(self.inside))
            .join(edges, self.place, "left")
            .withColumn(into, F.coalesce(into, "_beyond"))
            .select(*placed.columns, into)
        )

    def _slice_edges(self, rows: DataFrame, packed: Column, forward: bool) -> DataFrame:
        position = F.struct(*self.order)
        pick = F.min_by if forward else F.max_by
        return rows.groupBy(*self.place).agg(
            pick(packed, position).alias("_edge"), F.min(position).alias("_from")
        )
