"""Shared by the training-data operators: picking columns, work tables, slices of bounded size."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import workdir

# A-Z and their lower case (texts are lower-cased in ASCII only), and white space.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ASCII_LOWER = bytes.maketrans(UPPER.encode(), LOWER.encode())
WORD = r"[^\x20\x09-\x0D]+"
SPACES = "\x20\x09\x0a\x0b\x0c\x0d"
SLICE_CHARS = 2_000_000
# Texts reach Python in batches of this size, by bytes and not by rows: rows may be very long. Spark's default is 16 times larger.
BATCH_BYTES = 4 * 1024 * 1024
# Rows that a scan decodes at a time: a few MB of texts, where Spark's default of 4096 rows takes some 12 MB, and twice that as its buffers double.
SCAN_ROWS = 512


def take(df: DataFrame, *names: str) -> DataFrame:
    """The first column of each exact name, and nothing else.

    Further columns are ignored, also those whose names clash with these or differ in case only. Sets the session's
    Arrow batches to ``BATCH_BYTES``, since what is taken mostly goes to Python, and its scans to ``SCAN_ROWS``.
    """
    df.sparkSession.conf.set("spark.sql.parquet.columnarReaderBatchSize", str(SCAN_ROWS))
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    have = df.columns
    lacking = [n for n in names if n not in have]
    if lacking:
        raise ValueError(f"no column {lacking} in {have}")
    flat = df.toDF(*[f"_{i}" for i in range(len(have))])
    return flat.select(*[F.col(f"_{have.index(n)}").alias(n) for n in names])


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write to the shared work folder and read back: cuts the lineage, survives lost executors.

    Nobody waits for a work table's marker of success, which would cost the driver a process in a local folder.
    """
    path = workdir(df.sparkSession, purpose)
    df.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sized(df: DataFrame, most_rows: int = 500_000) -> DataFrame:
    """A written narrow table, marked for broadcast only if it was counted to be small."""
    return F.broadcast(df) if df.limit(most_rows + 1).count() <= most_rows else df


def numbered(docs: DataFrame) -> tuple[DataFrame, Callable[[str], str]]:
    """The frame with its columns renamed _0, _1, ... and the new name of the first column of each exact name.

    Further columns can then clash neither with each other nor with what an operator adds. ``toDF(*docs.columns)`` names
    them back.
    """
    names = docs.columns

    def of(name: str) -> str:
        if name not in names:
            raise ValueError(f"no column {name!r} in {names}")
        return f"_{names.index(name)}"

    return docs.toDF(*[f"_{i}" for i in range(len(names))]), of


def without(docs: DataFrame, found: DataFrame, purpose: str) -> DataFrame:
    """The documents, all columns, whose (doc_id, xxhash64 of the text) is not among ``found``'s."""
    bad = found.select(F.col("doc_id").alias("bad_id"), F.col("text_hash").alias("bad_hash")).distinct()
    bad = sized(stored(bad, purpose))
    wide, of = numbered(docs)
    here = F.col(of("doc_id")).cast("long").eqNullSafe(F.col("bad_id")) & (F.xxhash64(of("text")) == F.col("bad_hash"))
    return wide.join(bad, here, "left_anti").toDF(*docs.columns)


def crc_remainder(id_column: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo; NULL ids count as the empty text."""
    return F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit("")).cast("binary")) % modulus


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def words(text: str | None) -> list[str]:
    """Words of a text after ASCII lower-casing; NULL has none.

    ``str.split`` would also split at other Unicode spaces, so those texts take the slower way.
    """
    if not text:
        return []
    low = text.encode("utf-8", "surrogatepass").translate(ASCII_LOWER).decode("utf-8", "surrogatepass")
    if low.isascii():
        if not any(c in low for c in "\x1c\x1d\x1e\x1f"):
            return low.split()
    elif not any(c in low for c in UNICODE_SPACES):
        return low.split()
    for c in SPACES[1:]:
        low = low.replace(c, " ")
    return [w for w in low.split(" ") if w]


# What str.split() takes for white space beyond SPACES.
UNICODE_SPACES = "".join(chr(c) for c in range(0x110000) if chr(c).isspace() and chr(c) not in SPACES)


def slices(texts: Iterable[str | None], size: int = SLICE_CHARS) -> Iterator[tuple[int, list[str]]]:
    """Runs of texts of about ``size`` characters with the index of the first; NULL becomes empty."""
    start, held, chars = 0, [], 0
    for i, text in enumerate(texts):
        held.append(text or "")
        chars += len(held[-1])
        if chars >= size:
            yield start, held
            start, held, chars = i + 1, [], 0
    if held:
        yield start, held
