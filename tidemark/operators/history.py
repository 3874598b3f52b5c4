"""Current state and effective-dated history from out-of-order change events."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.duplicates import keep_last
from tidemark.operators.hotkeys import HotKeys
from tidemark.operators.timeline import Timeline

DELETE = "DELETE"
# The columns of the published current state.
CURRENT_COLUMNS = (
    "batch_id", "site_id", "product_id", "lot_number", "manufactured_at",
    "release_status", "effective_at", "sequence_number", "schema_version",
)
# Columns of the change log that are not part of a version (fixed list of the CDC contract).
UNVERSIONED = (
    "event_id", "operation", "source_file", "source_system",
    "ingest_timestamp_utc", "pipeline_run_id", "record_hash", "schema_version",
)
TRACKED = ("release_status", "site_id", "product_id")


def current_state(
    log: DataFrame,
    keys: Sequence[str] = ("batch_id",),
    order: Sequence[str] = ("sequence_number", "effective_at"),
    columns: Sequence[str] | None = CURRENT_COLUMNS,
    deleted: Column | None = None,
    tie_break: Sequence[str] = (),
) -> DataFrame:
    """Newest event per key; keys whose newest event is a delete have no current state.

    Events equal in ``order`` and ``tie_break`` are settled by their whole content, the versioned columns
    first, as in the tracked history: the largest stays, whatever the order of the input.
    """
    gone = deleted if deleted is not None else F.col("operation") == DELETE
    names = list(columns) if columns else log.columns
    settled = {*keys, *order, *tie_break}
    versioned = [c for c in dict.fromkeys([*TRACKED, *log.columns]) if c in log.columns and c not in settled]
    state = [c for c in versioned if c not in UNVERSIONED]
    rest = [c for c in versioned if c in UNVERSIONED]
    events = log.select(*dict.fromkeys([*keys, *order, *tie_break, *versioned]), F.coalesce(gone, F.lit(False)).alias("_gone"))
    newest = keep_last(events, list(keys), [*order, *tie_break, *state, "_gone", *rest])
    return newest.filter(~F.col("_gone")).select(*names)


def known_batches(log: DataFrame) -> DataFrame:
    """One row per batch that ever appeared, with its newest site and product; the lookup of routing."""
    columns = ["batch_id", "site_id", "product_id"]
    return current_state(log, columns=columns, deleted=F.lit(False))


def history_recomputed(
    master: DataFrame, changes: DataFrame, hot: HotKeys | None = None
) -> DataFrame:
    """SCD type 2 where every event is a version, ordered by effective start and then sequence.

    Operations are not interpreted: there are no deletes here. Unparsable effective times give a
    NULL start, which sorts first. Equal (batch, sequence, start) events keep one row, the largest
    by status and schema version.
    """
    carried = ["site_id", "product_id", "lot_number"]
    start = F.try_to_timestamp(F.col("effective_at")).alias("effective_start_utc")
    version = ["release_status", "sequence_number", start, "schema_version"]
    baseline = master.select("batch_id", *carried, *version)
    changed = changes.select("batch_id", *version).join(master.select("batch_id", *carried), "batch_id")
    versions = baseline.unionByName(changed)
    timeline = Timeline(("batch_id",), ("effective_start_utc", "sequence_number"), hot=hot or HotKeys())
    content = ["release_status", "schema_version", *carried]
    # Cuts and summary need keys and positions only: narrow scans, combined before their shuffle.
    positions = versions.select("batch_id", "effective_start_utc", "sequence_number")
    cuts = timeline.cuts(positions)
    placed = timeline.lay_out(versions, content, cuts)
    starts = timeline.mark(positions, cuts)
    dated = timeline.restore(
        timeline.with_neighbour(placed, "_next", ["effective_start_utc"], forward=True, edges_from=starts)
    )
    ended = dated.withColumn("effective_end_utc", F.col("_next.effective_start_utc"))
    # The last version is the one without a successor; a successor's unparsable time also gives a NULL end.
    return with_current_flags(ended, end="_next").select(
        "batch_id", *carried, "release_status", "sequence_number", "effective_start_utc",
        "effective_end_utc", "is_current", "is_current_int", "schema_version",
    )


def history_tracked(
    log: DataFrame,
    keys: Sequence[str] = ("batch_id",),
    sequence: Sequence[str] = ("sequence_number", "effective_at"),
    tracked: Sequence[str] = TRACKED,
    excluded: Sequence[str] = UNVERSIONED,
    deleted: Column | None = None,
    slice_by: Column | None = None,
    hot: HotKeys | None = None,
) -> DataFrame:
    """SCD type 2 where a new version starts only when a tracked column changes.

    Events are ordered by ``sequence`` alone, whatever their arrival order. Untracked columns are
    updated in place on the open version; a delete closes it and opens none. Versions carry the
    first sequence values as ``start_<column>`` and the next version's (or delete's) as ``end_<column>``.
    """
    keys, sequence, tracked = list(keys), list(sequence), list(tracked)
    gone = deleted if deleted is not None else F.col("operation") == DELETE
    untracked = [c for c in log.columns if c not in {*keys, *sequence, *tracked, *excluded}]
    events = log.select(
        *keys, *sequence, *tracked, *untracked, F.coalesce(gone, F.lit(False)).alias("_gone")
    )
    timeline = Timeline(tuple(keys), tuple(sequence), slice_by, hot or HotKeys())
    state = [*tracked, *untracked, "_gone"]
    # Events with equal keys and sequence are one event; the largest by content wins.
    placed = timeline.lay_out(events, state, timeline.cuts(log.select(*keys, *sequence)))

    # Inside a slice: the row before, and the next row that starts a version. A slice's first row
    # waits for the slice before it.
    seen = placed.withColumn("_before", F.lag(F.struct(*state)).over(timeline.inside))
    follows = F.col("_before").isNotNull()
    start = F.when(follows & _differs(tracked, F.col("_before")), F.struct(*sequence, "_before"))
    slices = _slice_summary(seen, timeline, tracked, state, start)
    rows = (
        seen.withColumn("_start", start)
        .withColumn("_after", F.expr("lead(_start) IGNORE NULLS").over(timeline.inside))
        .join(slices, timeline.place, "left")
        .withColumn("_before", F.coalesce("_before", "_earlier"))
        .withColumn("_after", F.coalesce("_after", "_later"))
    )
    opens = F.col("_before").isNull() | _differs(tracked, F.col("_before"))
    versions = timeline.restore(rows.filter(opens & ~F.col("_gone")))

    versions = versions.withColumns({f"start_{c}": F.col(c) for c in sequence}).withColumns(
        {f"end_{c}": F.col(f"_after.{c}") for c in sequence}
    )
    versions = versions.withColumn("is_current", F.col("_after").isNull())
    # Untracked values are those of a version's last event: the key's newest event for the open
    # version, else the event just before the next version's first.
    last = {
        c: F.when(F.col("is_current"), F.col(f"_newest.{c}")).otherwise(F.col(f"_after._before.{c}"))
        for c in untracked
    }
    versions = versions.withColumns(last) if last else versions
    names = [f"{edge}_{c}" for edge in ("start", "end") for c in sequence]
    return versions.select(*keys, *tracked, *untracked, *names, "is_current")


def _differs(tracked: Sequence[str], before: Column, now: Column | None = None) -> Column:
    """Whether an event starts a version after ``before``: a delete on either side, or a tracked change."""

    def value(name: str) -> Column:
        return F.col(name) if now is None else now[name]

    changed = before["_gone"] | value("_gone")
    for name in tracked:
        changed = changed | ~value(name).eqNullSafe(before[name])
    return changed


def _slice_summary(
    seen: DataFrame, timeline: Timeline, tracked: Sequence[str], state: Sequence[str], start: Column
) -> DataFrame:
    """Per (key, slice): the row before the slice, the next version start after it, the key's last row."""
    position = F.struct(*timeline.order)
    first, last = F.struct(*timeline.order, *state), F.struct(*state)
    summary = seen.groupBy(*timeline.place).agg(
        F.min(position).alias("_from"),
        F.min_by(first, position).alias("_first"),
        F.max_by(last, position).alias("_last"),
        F.min_by(start, F.when(start.isNotNull(), position)).alias("_inner"),
    )
    whole = timeline.across.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    summary = summary.withColumn("_earlier", F.lag("_last").over(timeline.across)).withColumn(
        "_newest", F.last("_last").over(whole)
    )
    entry = F.struct(*[F.col("_first")[c].alias(c) for c in timeline.order], F.col("_earlier").alias("_before"))
    opens = F.col("_earlier").isNull() | _differs(tracked, F.col("_earlier"), F.col("_first"))
    summary = summary.withColumn("_opening", F.when(opens, entry).otherwise(F.col("_inner")))
    later = F.expr("lead(_opening) IGNORE NULLS").over(timeline.across)
    return summary.withColumn("_later", later).select(*timeline.place, "_earlier", "_later", "_newest")


def with_current_flags(df: DataFrame, end: str = "effective_end_utc") -> DataFrame:
    """Derive ``is_current`` and its 0/1 twin from an open end or a missing successor."""
    return df.withColumn("is_current", F.col(end).isNull()).withColumn(
        "is_current_int", F.col("is_current").cast("int")
    )


def publishable_history(tracked_history: DataFrame) -> DataFrame:
    """Tracked history under the published column names, with parsed start and end times.

    ``is_current`` comes from the missing successor, not from a NULL end time.
    """
    return (
        tracked_history.withColumn(
            "effective_start_utc", F.try_to_timestamp(F.col("start_effective_at"))
        )
        .withColumn("effective_end_utc", F.try_to_timestamp(F.col("end_effective_at")))
        .withColumn("is_current_int", F.col("is_current").cast("int"))
        .withColumnRenamed("start_sequence_number", "sequence_number")
        .drop("start_effective_at", "end_effective_at", "end_sequence_number")
    )
