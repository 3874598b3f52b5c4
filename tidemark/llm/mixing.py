"""Mixing sources to target weights, in DataFrame operations only.

Every document gets a hash-random key. Inside its source the rows are put in key order in two
levels: the key's leading part deals them into ranges of about ``range_rows`` rows, so that a source
with a third of all rows is many ranges, and one window sorts inside each range. Totals per range
make the prefix sums global. The prefix sum then says where a source's budget ends: whole epochs
first, and the rest is cut at the exact word.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import WORD, numbered, sized, stored, take

RANGE_ROWS = 50_000


def _size(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _key(seed: str, doc_id: Column) -> Column:
    return F.substring(F.sha2(F.concat_ws(":", F.lit(seed), doc_id.cast("string")), 256), 1, 16)


def sizes(docs: DataFrame, seed: str, columns: Sequence[str] = ("doc_id", "text", "source")) -> DataFrame:
    """doc_id, source, size and key of every row, written once so that texts are read once."""
    doc_id, text, source = columns
    return stored(
        take(docs, doc_id, text, source).select(
            F.col(doc_id).alias("doc_id"),
            F.col(source).alias("source"),
            _size(F.col(text)).alias("size"),
            _key(seed, F.col(doc_id)).alias("key"),
        ),
        "mixing-sizes",
    )


def targets(rows: DataFrame, weights: Sequence[int], share: float, most: float) -> DataFrame:
    """One row per source: its words, its rows and its target.

    A source's target is ``weight * level``, or ``most`` times its words where that is less; the level
    is where the targets add up to ``share`` of all words. Sorted by how soon they are full, the full
    sources are the leading ones, so prefix sums give the level without repeated rounds. The windows
    hold one narrow row per source.
    """
    per = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("source_rows"))
    # NULL last, others by code point (Spark compares UTF-8 bytes).
    place = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod(place, F.lit(len(weights))) + 1).cast("int"))
    per = per.withColumn("weight", weight.cast("long"))
    most_words = F.col("source_size") * F.lit(float(most))
    order = Window.orderBy("fills_at", F.col("source").isNull(), "source")
    before, whole = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    per = (
        per.withColumn("most", most_words)
        .withColumn("fills_at", F.col("most") / F.col("weight"))
        .withColumn("_full", F.coalesce(F.sum("source_size").over(before), F.lit(0)) * F.lit(float(most)))
        .withColumn("_used", F.coalesce(F.sum("weight").over(before), F.lit(0)))
        .withColumn("_all", F.sum("source_size").over(whole) * F.lit(float(share)))
        .withColumn("_weights", F.sum("weight").over(whole))
        .withColumn("_level", (F.col("_all") - F.col("_full")) / (F.col("_weights") - F.col("_used")))
        .withColumn("_open", F.when(F.col("fills_at") > F.col("_level"), F.struct("fills_at", "_level")))
        .withColumn("level", F.min("_open").over(whole)["_level"])
    )
    full = F.col("level").isNull() | (F.col("fills_at") <= F.col("level"))
    target = F.when(full, F.col("most")).otherwise(F.col("level") * F.col("weight"))
    return per.select("source", "source_size", "source_rows", target.alias("target"))


def _placed(sized_rows: DataFrame, weights: Sequence[int], share: float, most: float, range_rows: int) -> DataFrame:
    """Rows (copies counted) with the words that precede them in their source, its epochs and rest."""
    plan = stored(targets(sized_rows, weights, share, most), "mixing-targets")
    rows = sized_rows.groupBy("source", "key", "doc_id", "size").agg(F.count(F.lit(1)).alias("copies"))
    # The table of sources was written, so Spark knows its size and broadcasts it only if it is small.
    known = plan.withColumnRenamed("source", "_source")
    rows = rows.join(known, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    part = F.conv(F.substring("key", 1, 12), 16, 10).cast("double") / F.lit(float(2**48))
    ranges = F.greatest(F.lit(1), F.ceil(F.col("source_rows") / F.lit(range_rows)))
    rows = rows.withColumn("_range", F.floor(part * ranges)).withColumn("_words", F.col("size") * F.col("copies"))

    per_range = rows.groupBy("source", "_range").agg(F.sum("_words").alias("_in_range"))
    earlier = Window.partitionBy("source").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_range.select(
        F.col("source").alias("_source"),
        F.col("_range").alias("_at"),
        F.coalesce(F.sum("_in_range").over(earlier), F.lit(0)).alias("_start"),
    )
    rows = rows.join(starts, F.col("source").eqNullSafe(F.col("_source")) & (F.col("_range") == F.col("_at")))
    inside = Window.partitionBy("source", "_range").orderBy("key", "doc_id", "size")
    before = F.coalesce(F.sum("_words").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rows = rows.withColumn("_before", F.col("_start") + before)
    budget = F.floor("target")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    return rows.withColumn("_epochs", epochs).withColumn("_rest", budget - F.col("_epochs") * F.col("source_size"))


def mix(
    docs: DataFrame,
    weights: Sequence[int] = (3, 1, 2),
    share: float = 1.5,
    most: float = 2.0,
    seed: str = "mix",
    range_rows: int = RANGE_ROWS,
    columns: Sequence[str] = ("doc_id", "text", "source"),
) -> DataFrame:
    """Per row: doc_id, size, source_size, target, taken, source.

    NULL and empty texts have size 0 and nothing taken. A NULL source is a source of its own. Rows
    equal in id, source and size are copies: they are counted once before the sort and given back one
    by one, each with its own share of the cut. Equal keys are ordered by id and size. An empty table
    gives no rows. Further columns are ignored.
    """
    rows = _placed(sizes(docs, seed, columns), weights, share, most, range_rows)
    rows = rows.withColumn("_copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
    left = F.col("_rest") - F.col("_before") - F.col("_copy") * F.col("size")
    taken = F.col("_epochs") * F.col("size") + F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), left))
    return rows.select("doc_id", "size", "source_size", "target", taken.cast("long").alias("taken"), "source")


def mixed(
    docs: DataFrame, weights: Sequence[int] = (3, 1, 2), share: float = 1.5, most: float = 2.0, seed: str = "mix",
    range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """The documents, all columns, of which the mix takes words, and how many: ``taken``.

    The prefix sums leave one cut per source; documents are held against it where they are, so texts are
    not shuffled. Copies at the very cut share its words evenly. NULL and empty texts have no words and go. A NULL source
    is a source of its own. Ties are ordered by id and size, so reruns agree; an empty table gives no rows. Further columns
    stay, whatever their names, but for one named ``taken``.
    """
    rows = _placed(sizes(docs, seed), weights, share, most, range_rows)
    place = F.struct("key", "doc_id", "size")
    end = F.col("_before") + F.col("_words")
    crossing = (F.col("_before") < F.col("_rest")) & (end > F.col("_rest"))
    cuts = rows.groupBy("source").agg(
        F.max("_epochs").alias("_epochs"),
        F.max(F.when(end <= F.col("_rest"), place)).alias("_whole"),
        F.max(F.when(crossing, F.struct(place.alias("at"), F.floor((F.col("_rest") - F.col("_before")) / F.col("copies")).alias("each")))).alias("_cut"),
    )
    cuts = sized(stored(cuts.withColumnRenamed("source", "_source"), "mixing-cuts"))
    wide, of = numbered(docs)
    text, doc_id = F.col(of("text")), F.col(of("doc_id"))
    own = wide.withColumns({"size": _size(text), "place": F.struct(_key(seed, doc_id).alias("key"), doc_id.alias("doc_id"), _size(text).alias("size"))})
    met = own.join(cuts, F.col(of("source")).eqNullSafe(F.col("_source")))
    more = F.when(F.col("place") <= F.col("_whole"), F.col("size")).when(F.col("place") == F.col("_cut.at"), F.col("_cut.each")).otherwise(0)
    words_taken = (F.col("_epochs") * F.col("size") + more).cast("long")
    kept = [(i, c) for i, c in enumerate(docs.columns) if c != "taken"]
    found = met.withColumn("words_taken", words_taken).filter("words_taken > 0")
    return found.select(*[f"_{i}" for i, _ in kept], "words_taken").toDF(*[c for _, c in kept], "taken")


def oracle_sql(seed: str = "mix") -> str:
    """The same mix in DuckDB, with plain windows over whole sources."""
    return f"""
WITH sized AS (
  SELECT doc_id, source,
         CASE WHEN text IS NULL THEN 0 ELSE len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) END::BIGINT AS size,
         substr(sha256(concat_ws(':', '{seed}', doc_id::VARCHAR)), 1, 16) AS key
  FROM documents),
per AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight
  FROM sized GROUP BY source),
filled AS (SELECT *, source_size * 2.0::DOUBLE AS most, (source_size * 2.0::DOUBLE) / weight AS fills_at FROM per),
levels AS (
  SELECT *, (sum(source_size) OVER ()::DOUBLE * 1.5::DOUBLE
             - coalesce(sum(source_size) OVER w, 0)::DOUBLE * 2.0::DOUBLE)
            / (sum(weight) OVER () - coalesce(sum(weight) OVER w, 0))::DOUBLE AS lvl
  FROM filled WINDOW w AS (ORDER BY fills_at, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
plan AS (
  SELECT source, source_size, CASE WHEN l IS NULL OR fills_at <= l THEN most ELSE l * weight END AS target
  FROM (SELECT *, (SELECT arg_min(lvl, fills_at) FROM levels WHERE fills_at > lvl) AS l FROM levels)),
placed AS (
  SELECT s.doc_id, s.size, p.source_size, p.target, s.source, floor(p.target)::BIGINT AS budget,
         coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.key, s.doc_id, s.size
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM sized s JOIN plan p ON s.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, target, source,
       (CASE WHEN source_size > 0 THEN (budget // source_size) * size
             + greatest(0, least(size, budget % source_size - before)) ELSE 0 END)::BIGINT AS taken
FROM placed"""
