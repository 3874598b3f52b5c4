"""File input: contract scans with source capture, landing, reconciliation and manifests."""

from __future__ import annotations

import fnmatch
import hashlib
from collections.abc import Iterator, Sequence

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidemark.functions.columns import digest
from tidemark.operators.content import content_digest
from tidemark.operators.contracts import GateFailed

# Part of a file digest's definition: digests compare only at one block size.
BLOCK_BYTES = 64 * 1024 * 1024


def read_json_lines(
    spark: SparkSession, paths: str | Sequence[str], schema: StructType, source_file: bool = True
) -> DataFrame:
    """JSON lines by contract. A field of the wrong type becomes NULL and its row survives."""
    scanned = spark.read.schema(schema).json(paths if isinstance(paths, str) else list(paths))
    if not source_file:
        return scanned
    return scanned.select("*", F.col("_metadata.file_path").alias("source_file"))


# Why a line did not fit the contract.
NO_OBJECT, WRONG_TYPE = "NOT_A_JSON_OBJECT", "WRONG_TYPE"


def scan_json_lines(spark: SparkSession, paths: str | Sequence[str], schema: StructType) -> DataFrame:
    """JSON lines by contract with every line that does not fit kept: columns, source_file, line_reason and raw_line.

    The text is kept of lines that are no JSON object (all fields NULL) and of those with a field of the wrong type (that
    field NULL); others have a NULL reason and text. Rows with a reason are routed, so no line is lost.
    """
    raw = "raw_line"
    wide = StructType([*schema.fields, StructField(raw, StringType())])
    # Read as text: a scan of JSON files refuses queries on the kept text alone.
    lines = spark.read.text(paths if isinstance(paths, str) else list(paths)).filter(F.trim("value") != "")
    parsed = lines.select(
        F.from_json("value", wide, {"columnNameOfCorruptRecord": raw}).alias("_line"), F.col("_metadata.file_path").alias("source_file")
    )
    reason = F.when(F.col(raw).isNotNull(), F.when(F.json_object_keys(raw).isNull(), NO_OBJECT).otherwise(WRONG_TYPE))
    rows = parsed.select("_line.*", "source_file")
    return rows.select(*schema.fieldNames(), "source_file", reason.alias("line_reason"), raw)


def with_extra_files(base: DataFrame, *extra: DataFrame) -> DataFrame:
    """Union by name; columns one side lacks are NULL."""
    for df in extra:
        base = base.unionByName(df, allowMissingColumns=True)
    return base


def landed_files(scanned: DataFrame) -> DataFrame:
    """Rows and bytes per file of a file scan, from its metadata columns: no directory listing."""
    return scanned.groupBy(
        F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.file_size").alias("bytes")
    ).agg(F.count(F.lit(1)).alias("rows"))


def reconcile_landing(scanned: DataFrame, expected_files: int, expected_rows: int) -> DataFrame:
    """One row: files, rows and bytes found, and whether files and rows are as expected."""
    return (
        landed_files(scanned)
        .agg(
            F.count(F.lit(1)).alias("files"),
            F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
            F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"),
        )
        .withColumn("matches", (F.col("files") == expected_files) & (F.col("rows") == expected_rows))
    )


def verify_landing(scanned: DataFrame, expected_files: int, expected_rows: int) -> dict[str, int]:
    """Raise unless exactly the expected files and rows landed."""
    found = reconcile_landing(scanned, expected_files, expected_rows).first()
    if not found.matches:
        raise GateFailed(
            f"landing has {found.files} files and {found.rows} rows; "
            f"expected {expected_files} files and {expected_rows} rows"
        )
    return {"files": found.files, "rows": found.rows, "bytes": found.bytes}


def land_files(spark: SparkSession, paths: Sequence[str], landing: str) -> DataFrame:
    """Copy text files to the landing folder, one folder per file, and report each copy.

    Reading and writing are split by file blocks, so a large file does not go through one task.
    Rows read come from the source, rows copied and bytes from what was written. The folder name
    starts with a digest of the path, so files of one name in two folders stay apart.
    """
    path, name = F.col("_metadata.file_path"), F.col("_metadata.file_name")
    folder = F.concat_ws("-", F.substring(F.sha2(path, 256), 1, 16), name).alias("copy")
    lines = spark.read.text(list(paths)).select("value", path.alias("source_file"), folder)
    lines.drop("source_file").write.mode("overwrite").partitionBy("copy").text(landing)
    read = lines.groupBy("source_file", "copy").agg(F.count(F.lit(1)).alias("rows_read"))
    # Per written part first: its size is a constant of the part and must count once.
    parts = spark.read.text(landing).groupBy("copy", path.alias("part"), F.col("_metadata.file_size").alias("size"))
    copied = (
        parts.agg(F.count(F.lit(1)).alias("rows"))
        .groupBy("copy")
        .agg(F.sum("rows").alias("rows_copied"), F.sum("size").alias("bytes_written"))
    )
    status = F.when(F.col("rows_read") == F.col("rows_copied"), "Succeeded").otherwise("Failed")
    return read.join(copied, "copy", "left").fillna(0).withColumn("status", status)


def file_manifest(
    spark: SparkSession, root: str, pattern: str = "*", block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """Every file under ``root``: path, bytes and ``blocks_sha256``.

    That is the SHA-256 of the SHA-256 digests of the file's blocks, in order, one a line: the same formula
    for every size; an empty file has no blocks. Blocks, not files, are the unit of work, so a large file is read by
    many tasks and no task holds more than a block. Files and folders whose names start with ``_`` or ``.`` are left
    out, as in all of Spark's scans.
    """
    options = {"recursiveFileLookup": "true", "pathGlobFilter": pattern}
    # Without the content column the scan only lists.
    listed = spark.read.format("binaryFile").options(**options).load(root).select("path", F.col("length").alias("bytes"))
    last = F.greatest(F.col("bytes") - 1, F.lit(0).cast("bigint"))
    starts = F.sequence(F.lit(0).cast("bigint"), last, F.lit(block_bytes).cast("bigint"))
    blocks = listed.select("path", "bytes", F.explode(starts).alias("start"))
    # A given number, since rows this narrow would be coalesced into one task that reads everything.
    blocks = blocks.repartition(4 * spark.sparkContext.defaultParallelism, "path", "start")

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            yield rows.assign(digest=[_block_sha256(p, s, block_bytes) for p, s in zip(rows["path"], rows["start"])])

    found = blocks.mapInPandas(hashed, "path STRING, bytes BIGINT, start BIGINT, digest STRING")
    in_order = F.transform(F.array_sort(F.collect_list(F.struct("start", "digest"))), lambda block: block["digest"])
    full = found.groupBy("path", "bytes").agg(digest(F.array_join(in_order, "\n")).alias("blocks_sha256"))
    empty = empty_files(spark, root, pattern).select("path", F.lit(0).cast("bigint").alias("bytes"), digest(F.lit("")).alias("blocks_sha256"))
    return full.unionByName(empty)


def empty_files(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """Paths of the files without bytes under ``root``, which Spark's scans skip.

    The driver lists the root folder only; each folder in it is listed by a task. ``pattern`` is matched against the
    file's name as in a shell.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(root)
    base = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(hadoop).toString().rstrip("/")
    system, place = _opened(base)

    def paths(system: fs.FileSystem, place: str, below: str, deep: bool) -> list[str]:
        listed = system.get_file_info(fs.FileSelector(f"{place}{below}", recursive=deep))
        names = [info.path[len(place.rstrip("/")) :] for info in listed if info.type == fs.FileType.File and not info.size]
        return [base + n for n in names if _shown(n) and fnmatch.fnmatchcase(n.rsplit("/", 1)[-1], pattern)]

    folders = [i.base_name for i in system.get_file_info(fs.FileSelector(place)) if i.type == fs.FileType.Directory and _shown(i.base_name)]

    def listed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, place = _opened(base)
        for rows in batches:
            yield pd.DataFrame({"path": [p for folder in rows["folder"] for p in paths(system, place, f"/{folder}", True)]}, dtype=object)

    below = spark.createDataFrame([(f,) for f in folders], "folder STRING")
    below = below.repartition(max(1, min(len(folders), 4 * spark.sparkContext.defaultParallelism)), "folder")
    here = spark.createDataFrame([(p,) for p in paths(system, place, "", False)], "path STRING")
    return here.unionByName(below.mapInPandas(listed, "path STRING"))


def _shown(path: str) -> bool:
    """Spark's scans leave out names that start with _ or . (but partition folders such as _a=1)."""
    return not any(n.startswith(".") or n.startswith("_") and "=" not in n for n in path.split("/") if n)


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


def _block_sha256(path: str, start: int, size: int) -> str:
    system, place = _opened(path)
    with system.open_input_file(place) as file:
        return hashlib.sha256(file.read_at(size, start)).hexdigest()


def relative_manifest(manifest: DataFrame, root: str) -> DataFrame:
    """The manifest with paths below ``root``, comparable between two places."""
    below = F.substring_index("path", root.rstrip("/") + "/", -1)
    return manifest.withColumn("path", below)


def dataset_digest(manifest: DataFrame, root: str) -> DataFrame:
    """One digest for all files of a manifest, by path below ``root``, size and file digest."""
    return content_digest(relative_manifest(manifest, root).select("path", "bytes", "blocks_sha256"), exclude=())


def manifest_differences(expected: DataFrame, found: DataFrame) -> DataFrame:
    """Files that only one of two relative manifests has, or whose content differs."""
    left = expected.select("path", F.col("blocks_sha256").alias("expected_digest"))
    right = found.select("path", F.col("blocks_sha256").alias("found_digest"))
    return left.join(right, "path", "full_outer").filter(~F.col("expected_digest").eqNullSafe(F.col("found_digest")))
