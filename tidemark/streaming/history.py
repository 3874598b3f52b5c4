"""SCD type 2 history kept up to date from a stream of change events in any order.

Three tables grow by one version a micro-batch, and no file that a reader may need is replaced:

* the **log** holds the events by (key bucket, micro-batch);
* the **history** holds the new state of each bucket that a micro-batch touched;
* the **heads** name every bucket's newest version and the first version of its log that counts. A micro-batch
  writes its heads last, so a reader sees all of it or nothing, and a repeated micro-batch starts from the same heads.

A micro-batch reads back the events of its own keys only and rebuilds those keys; the others of their buckets are carried
over as they are. Once a bucket's log has many versions its events are rewritten into one, so a key's events lie in few files.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

BUCKET = "key_bucket"
BATCH = "arrival_batch"
ARRIVED = "_arrived"
PRESENT = "_present"
HEAD_SCHEMA = f"{BUCKET} INT, version BIGINT, log_from BIGINT, log_versions INT, {BATCH} BIGINT"


def maintain_history(
    changes: DataFrame,
    keys: Sequence[str],
    build: Callable[[DataFrame], DataFrame],
    log_path: str,
    history_path: str,
    checkpoint: str,
    buckets: int = 256,
    log_versions: int = 8,
) -> StreamingQuery:
    """Follow the available changes; ``build`` makes the versions of whole keys from all of their events.

    A late event changes its own key's past only. A bucket's events lie in at most ``log_versions`` versions of the log.
    A repeated micro-batch gives the same tables. ``build`` itself splits hot keys.
    """

    # The rebuild reads stored tables in the caller's session, where adaptive execution is on; the
    # session of a micro-batch has it switched off.
    spark = changes.sparkSession

    def apply(batch: DataFrame, batch_id: int) -> None:
        heads = read_heads(spark, history_path, before=batch_id)
        placed = batch.withColumns({BUCKET: _bucket(keys, buckets), ARRIVED: F.lit(batch_id).cast("long")})
        # At most ``buckets`` small integers come back, to read log and history by partition.
        touched = sorted(row[0] for row in placed.select(BUCKET).distinct().collect())
        if not touched:
            return
        known = {b: heads[b] for b in touched if b in heads}
        full = {b: h for b, h in known.items() if h.log_versions >= log_versions}
        log = spark.read.schema(placed.withColumn(BATCH, F.lit(0).cast("long")).schema).parquet
        events = placed
        if full:
            events = placed.unionByName(log(log_path).filter(_from_version(full.values())).drop(BATCH))
        _overwrite(events.withColumn(BATCH, F.lit(batch_id)), log_path, [BUCKET, BATCH])

        moved = {b: Row(**{BUCKET: b, "version": batch_id, "log_from": batch_id, "log_versions": 1}) for b in touched}
        for b, h in known.items():
            if b not in full:
                moved[b] = Row(**{BUCKET: b, "version": batch_id, "log_from": h.log_from, "log_versions": h.log_versions + 1})
        stored = log(log_path).filter(_from_version(moved.values()))
        own = stored.filter((F.col(BATCH) == batch_id) & (F.col(ARRIVED) == batch_id)).select(*keys).distinct()
        rebuilt = build(_with_keys(stored, own, keys, "left_semi").drop(BUCKET, BATCH, ARRIVED))
        rebuilt = rebuilt.withColumns({BUCKET: _bucket(keys, buckets), PRESENT: F.lit(True)})
        state = rebuilt
        if known:
            columns = rebuilt.withColumn(BATCH, F.lit(0).cast("long")).schema
            held = spark.read.schema(columns).parquet(history_path).filter(_at_version(known.values()) & F.col(PRESENT))
            state = state.unionByName(_with_keys(held.drop(BATCH), own, keys, "left_anti"))
        # A marker row per bucket, so that a bucket without versions has a file too.
        markers = spark.createDataFrame([(b, False) for b in touched], f"{BUCKET} INT, {PRESENT} BOOLEAN")
        state = state.unionByName(markers, allowMissingColumns=True)
        _overwrite(state.withColumn(BATCH, F.lit(batch_id)), history_path, [BUCKET, BATCH])

        rows = [(h[BUCKET], h.version, h.log_from, h.log_versions, batch_id) for h in {**heads, **moved}.values()]
        _overwrite(spark.createDataFrame(rows, HEAD_SCHEMA).coalesce(1), _heads_path(history_path), [BATCH])

    query = (
        changes.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def read_heads(spark: SparkSession, history_path: str, before: int | None = None) -> dict[int, Row]:
    """Each bucket's newest version, as of the last micro-batch (before the given one); one row a bucket."""
    try:
        written = spark.read.schema(HEAD_SCHEMA).parquet(_heads_path(history_path))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return {}
    if before is not None:
        written = written.filter(F.col(BATCH) < before)
    newest = written.agg(F.max(BATCH)).first()[0]
    return {row[BUCKET]: row for row in written.filter(F.col(BATCH) == newest).collect()} if newest is not None else {}


def read_history(spark: SparkSession, history_path: str) -> DataFrame:
    """The versions of a maintained history, as of its last whole micro-batch."""
    at = _at_version(read_heads(spark, history_path).values())
    return spark.read.parquet(history_path).filter(at & F.col(PRESENT)).drop(PRESENT, BUCKET, BATCH)


def _heads_path(history_path: str) -> str:
    # Scans of the history skip names that begin with an underscore.
    return f"{history_path.rstrip('/')}/_heads"


def _bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _with_keys(df: DataFrame, own: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Rows whose keys are (or are not) among ``own``'s; NULL keys are equal."""
    named = own.select(*[F.col(k).alias(f"_own_{k}") for k in keys])
    return df.join(named, [F.col(k).eqNullSafe(F.col(f"_own_{k}")) for k in keys], how)


def _grouped(heads: Iterable[Row], field: str) -> dict[int, list[int]]:
    groups: dict[int, list[int]] = {}
    for head in heads:
        groups.setdefault(head[field], []).append(head[BUCKET])
    return groups


def _from_version(heads: Iterable[Row]) -> Column:
    """Partitions of the log that count, as conditions on partition columns alone."""
    parts = [F.col(BUCKET).isin(b) & (F.col(BATCH) >= start) for start, b in sorted(_grouped(heads, "log_from").items())]
    return reduce(Column.__or__, parts, F.lit(False))


def _at_version(heads: Iterable[Row]) -> Column:
    parts = [F.col(BUCKET).isin(b) & (F.col(BATCH) == version) for version, b in sorted(_grouped(heads, "version").items())]
    return reduce(Column.__or__, parts, F.lit(False))


def _overwrite(df: DataFrame, path: str, partitions: list[str]) -> None:
    (
        df.hint("rebalance", *partitions)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partitions)
        .parquet(path)
    )
