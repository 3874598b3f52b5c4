"""Message log input: Kafka, its file-based stand-in, and bounded replay."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.operators.contracts import GateFailed
from tidemark.operators.hotkeys import NAME, HotKeys, name_rows
from tidemark.operators.selection import CUTS, quantile_cuts, range_of
from tidemark.schemas import MESSAGE

MESSAGES_PER_TRIGGER = 5000
MESSAGES_PER_FILE, LEAST_FILES = 1_000_000, 4


def kafka_stream(
    spark: SparkSession, servers: str, topic: str, jaas: str | None = None, rate: int = MESSAGES_PER_TRIGGER, **options: str
) -> DataFrame:
    """Subscribe from the earliest offset, ``rate`` messages a micro-batch; SASL where credentials are given."""
    settings = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
        "failOnDataLoss": "false",
        "maxOffsetsPerTrigger": str(rate),
    }
    if jaas:
        settings |= {
            "kafka.security.protocol": "SASL_SSL",
            "kafka.sasl.mechanism": "PLAIN",
            "kafka.sasl.jaas.config": jaas,
        }
    return spark.readStream.format("kafka").options(**{**settings, **options}).load()


def message_file_stream(
    spark: SparkSession, path: str, files_per_trigger: int | None = 1, bytes_per_trigger: str | None = None
) -> DataFrame:
    """The same columns from a folder of replayed message files; the rate is a number of files or of bytes."""
    stream = spark.readStream.schema(MESSAGE)
    if bytes_per_trigger:
        return stream.option("maxBytesPerTrigger", bytes_per_trigger).parquet(path)
    return (stream.option("maxFilesPerTrigger", files_per_trigger) if files_per_trigger else stream).parquet(path)


def latest_offsets(spark: SparkSession, path: str) -> DataFrame:
    """Each partition's next offset over all replayed messages: partition, latest_offset."""
    sent = spark.read.schema(MESSAGE).parquet(path)
    return sent.groupBy("partition").agg((F.max("offset") + 1).alias("latest_offset"))


def text_lines(spark: SparkSession, paths) -> DataFrame:
    """Lines of text files with a sortable place: file, block and line within the block."""
    lines = spark.read.text(paths if isinstance(paths, str) else list(paths))
    return lines.select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
    )


def is_message(value: Column, required: str = "event_id") -> Column:
    """A JSON object that has the required member, whatever the member's value."""
    members = F.json_object_keys(value)
    return F.coalesce(F.array_contains(members, required), F.lit(False))


def first_messages(lines: DataFrame, limit: int, block: list[str], within: str, hot: HotKeys | None = None) -> DataFrame:
    """The first ``limit`` lines in (block, within) order with their ordinal from 0; ``within`` is unique in a block.

    Large blocks are cut into ranges of about ``hot.slice_rows`` lines by sampled quantiles of ``within``. Ranges are numbered
    by a running count over one row per range; lines are ranked inside their range only, and only in ranges
    that start before the limit. Nothing but the summary of ranges is ordered globally.
    """
    hot = hot or HotKeys()
    named = name_rows(lines, block)
    cuts = quantile_cuts(named, block, [within], hot)
    ranged = named.join(F.broadcast(cuts), NAME, "left").withColumn("_range", range_of([within])).drop(NAME, CUTS)
    place = [*block, "_range"]
    sizes = ranged.groupBy(*place).agg(F.count(F.lit(1)).alias("_n"))
    # One row per file block or million lines: the summary of 100 TB in 128 MB blocks is under a million rows.
    before = Window.orderBy(*place).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    wanted = starts.filter(F.col("_start") < limit)
    inside = F.row_number().over(Window.partitionBy(*place).orderBy(within)) - 1
    placed = ranged.join(wanted, place).withColumn("ordinal", F.col("_start") + inside)
    return placed.filter(F.col("ordinal") < limit).drop("_start", "_range")


def check_replay(messages: DataFrame, limit: int, required: str = "event_id") -> None:
    """Exactly ``limit`` lines, all of them messages, else nothing may be emitted."""
    found = messages.agg(
        F.count(F.lit(1)).alias("n"), F.count_if(~is_message(F.col("value"), required)).alias("bad")
    ).first()
    if found.n < limit:
        raise GateFailed(f"source contains {found.n} messages but {limit} were requested")
    if found.bad:
        raise GateFailed(f"{found.bad} lines are not a JSON object with {required}")


def as_messages(messages: DataFrame, topic: str, partitions: int = 2) -> DataFrame:
    """Ordinals become Kafka coordinates: round-robin partitions, offsets counting up in each."""
    return messages.select(
        F.lit(None).cast("string").alias("key"),
        "value",
        F.lit(topic).alias("topic"),
        F.pmod(F.col("ordinal"), F.lit(partitions)).cast("int").alias("partition"),
        F.floor(F.col("ordinal") / partitions).alias("offset"),
        F.current_timestamp().alias("timestamp"),
    )


def replay(
    lines: DataFrame,
    limit: int,
    topic: str,
    target: str,
    block: list[str] | None = None,
    within: str = "line",
    files: int | None = None,
    partitions: int = 2,
    servers: str | None = None,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Emit exactly ``limit`` messages in source order to Kafka or to message files; returns a receipt row.

    All lines are checked before the first is emitted. A file holds a range of ordinals, so reading
    files in order replays the source order. Without a number of files there is one per ``MESSAGES_PER_FILE``.
    """
    if limit <= 0:
        raise ValueError("message limit must be positive")
    if not topic.strip():
        raise ValueError("topic is required")
    chosen = first_messages(lines, limit, block or ["file", "block"], within, hot)
    files = files or max(LEAST_FILES, -(-limit // MESSAGES_PER_FILE))
    check_replay(chosen, limit)
    messages = as_messages(chosen, topic, partitions)
    spark = lines.sparkSession
    if servers:
        addressed = messages.select("key", "value", "topic", "partition")
        addressed.write.format("kafka").option("kafka.bootstrap.servers", servers).save()
        emitted = messages
    else:
        ordered = messages.repartitionByRange(files, "offset", "partition").sortWithinPartitions(
            "offset", "partition"
        )
        ordered.write.mode("overwrite").parquet(target)
        emitted = spark.read.schema(MESSAGE).parquet(target)
    return emitted.agg(
        F.lit(topic).alias("topic"),
        F.lit(limit).cast("bigint").alias("events_attempted"),
        F.count(F.lit(1)).alias("events_emitted"),
        F.lit(True).alias("bounded"),
        F.lit(False).alias("connection_material_included"),
    )
