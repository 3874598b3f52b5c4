"""Text columns: redaction, disallowed terms, search and alert filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import REDACTIONS, contains_all_filters, redact, terms_found
from tidemark.operators.joins import BROADCAST_ROWS, broadcast_if_small
from tidemark.session import workdir


def redacted(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The frame with whole texts redacted.

    Each pattern is its own projection, so a text is rewritten once per pattern and not re-evaluated
    inside the next one.
    """
    for rule in REDACTIONS:
        df = df.withColumns({c: redact(F.col(c), [rule]) for c in columns})
    return df


def term_hits(df: DataFrame, key: str, text: str, terms: Sequence[str]) -> DataFrame:
    """One row per (document, term) that occurs, case ignored."""
    lowered = df.select(key, F.lower(text).alias("_text"))
    return lowered.select(key, F.explode(terms_found(F.col("_text"), terms)).alias("term"))


# Letters of the grams that texts and terms are joined by, of a long piece of a text, and of a piece that is cut into grams.
GRAM, PIECE, SHORT = 4, 65_536, 256
# Letters outside the basic plane, which Java's expressions count as two.
ASTRAL = r"[\x{10000}-\x{10FFFF}]"


def term_matches(
    df: DataFrame, key: str, text: str, terms: DataFrame, term: str, gram: int = GRAM, piece: int = PIECE, most: int = BROADCAST_ROWS
) -> DataFrame:
    """One row per (document, term) that occurs, case ignored, for any number of terms.

    Each term is filed under its rarest gram of four letters (a shorter term under itself), with the gram's place in it and
    its length. Texts are cut into grams; where one is on file, the letters around it that such a term would have are cut
    out, pass 64 bits of the terms' hashes, and meet the terms by an equi-join. So the work grows with the texts and the
    hits, not with texts times terms, and no text is shuffled. Only places and lengths are broadcast, never terms unless
    they are few: ``most`` rows at a time, and the texts are read again for each further ``most``. Texts are taken in
    overlapping pieces, so a long one needs no more memory. NULL and empty texts and terms match nothing.
    """
    spark = df.sparkSession
    place = workdir(spark, "terms")

    def kept(part: DataFrame, name: str) -> DataFrame:
        part.write.parquet(f"{place}/{name}")
        return spark.read.parquet(f"{place}/{name}")

    wanted = kept(terms.select(F.lower(term).alias("term")).filter(F.length("term") > 0).distinct(), "wanted")
    grams = wanted.select("term", F.explode(_grams(F.col("term"), gram)).alias("gram"))
    rarity = kept(grams.groupBy("gram").agg(F.count(F.lit(1)).alias("n")), "rarity")
    filed = grams.join(broadcast_if_small(rarity), "gram").groupBy("term").agg(F.min_by("gram", F.struct("n", "gram")).alias("gram"))
    filed = filed.withColumns({"offset": F.position("gram", "term") - 1, "length": F.length("term")})
    bit = F.pmod(F.xxhash64("term"), F.lit(64)).cast("int")
    shapes = kept(filed.groupBy("gram", "offset", "length").agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit)).alias("bits")), "shapes")
    # The lengths of short terms, ``gram`` numbers at most, the overlap that no term is longer than, and how often texts are read.
    widths, overlap, n = shapes.agg(F.collect_set(F.length("gram")), F.max("length"), F.count(F.lit(1))).first()
    if not widths:
        return df.select(key, F.lit(None).cast("string").alias("term")).limit(0)
    lowered = df.select(key, F.lower(text).alias("_text")).filter(F.length("_text") > 0)
    # Long pieces first, then short ones: cutting takes time with a text's length, and every gram's row carries its piece.
    pieces = _pieces(_pieces(lowered, key, piece, overlap), key, max(SHORT, overlap), overlap)
    met = pieces.select(key, "_text", F.posexplode(_all_grams(F.col("_text"), gram)).alias("at", "gram"))
    if short := [width for width in sorted(widths) if width < gram]:
        # A shorter gram is a whole term, so that its places don't matter.
        whole = F.array_distinct(F.flatten(F.array(*[_all_grams(F.col("_text"), width) for width in short])))
        met = met.union(pieces.select(key, "_text", F.lit(0).alias("at"), F.explode(whole).alias("gram")))

    def found(some: DataFrame) -> DataFrame:
        near = met.join(F.broadcast(some), "gram").filter("at >= offset")
        whole = F.when(F.length("gram") == F.col("length"), F.col("gram")).otherwise(F.substring("_text", F.col("at") - F.col("offset") + 1, F.col("length")))
        hits = near.select(key, "bits", whole.alias("term"))
        return hits.filter(F.getbit("bits", bit) == 1).select(key, "term").distinct()

    rounds = -(-n // most)
    if rounds == 1:
        hits = found(shapes)
    else:
        for i in range(rounds):
            found(shapes.filter(F.pmod(F.xxhash64("gram"), F.lit(rounds)) == i)).write.mode("append").parquet(f"{place}/found")
        hits = spark.read.schema(met.select(key, F.col("gram").alias("term")).schema).parquet(f"{place}/found").distinct()
    return hits.join(broadcast_if_small(wanted), "term", "left_semi").select(key, "term")


def _pieces(lowered: DataFrame, key: str, size: int, overlap: int) -> DataFrame:
    starts = F.sequence(F.lit(1), F.length("_text"), F.lit(size))
    return lowered.select(key, F.explode(F.transform(starts, lambda at: F.substring("_text", at, F.lit(size + overlap)))).alias("_text"))


def _all_grams(text: Column, width: int) -> Column:
    by_place = F.transform(F.sequence(F.lit(1), F.greatest(F.length(text) - width + 1, F.lit(1))), lambda at: F.substring(text, at, F.lit(width)))
    cut = F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{width}}}))"), F.lit(1))
    return F.when(F.rlike(text, F.lit(ASTRAL)), by_place).otherwise(cut)


def _grams(term: Column, width: int) -> Column:
    return F.when(F.length(term) <= width, F.array(term)).otherwise(F.array_distinct(_all_grams(term, width)))


def search(df: DataFrame, status: str, wanted: str, parts: Sequence[str], query: str) -> DataFrame:
    """Rows with the wanted status (or ALL) whose text contains the query."""
    return df.filter(contains_all_filters(F.col(status), wanted, [F.col(p) for p in parts], query))


def alerts(df: DataFrame, conditions: dict[str, str]) -> DataFrame:
    """Rows, batch or streaming, where every named column has its given value."""
    matches: Column = F.lit(True)
    for column, value in conditions.items():
        matches = matches & (F.col(column) == value)
    return df.filter(matches)


FAILED_ADMINISTRATION = {"category": "Administrative", "status": "Failed"}
