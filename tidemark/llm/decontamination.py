"""Benchmark decontamination by spaced seeds.

A mask picks six positions of a run of words and ignores the others, so a run hits although words
at ignored positions were changed. The masks are chosen so that wherever the changed words lie, each overlap that counts, and each
whole item of ten to twelve words with two changed, has a hit (``tests/llm`` goes through all placements). An
item of five to nine words is its own mask: it is found verbatim. Seeds of documents meet seeds of benchmark items in an equi-join;
around each hit the document's words are laid against the item's, and the overlap counts if at least
``share`` of its words agree.

The documents' seeds are thinned before the join by a filter of fixed size that holds the bits of all
benchmark seeds; it lets false ones through and loses none, whatever the benchmark's size.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import slices, stored, take, without

MASKS = ("1101111", "111010011", "1110001011", "10111011", "1100011101", "10111101")
SPAN = 10
# Items of these numbers of words are found only verbatim; shorter ones are no evidence.
SHORT = range(5, SPAN)
FILTER_BITS = 25
CONTEXT = 64
WORDS, SHARE = 13, 0.8
# Scripts without spaces between words (Thai to Burmese, Khmer, kana, Chinese characters): each character is a word.
UNSPACED = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
CHARACTER, TOKEN, MIXED_TOKEN = re.compile(f"[{UNSPACED}]"), re.compile(r"\w+"), re.compile(rf"[{UNSPACED}]|[^\W{UNSPACED}]+")
MIX = np.random.default_rng(3).integers(1, 2**63, SPAN, dtype=np.uint64) | np.uint64(1)
HELD_IDS = 500_000


class TokenIds(dict):
    """64-bit ids of words, remembered for a bounded number of them."""

    def __missing__(self, word: str) -> int:
        self[word] = found = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"), 7)
        return found

    def of(self, text: str) -> np.ndarray:
        if len(self) > HELD_IDS:
            self.clear()
        token = TOKEN if text.isascii() or not CHARACTER.search(text) else MIXED_TOKEN
        return np.fromiter(map(self.__getitem__, token.findall(text.lower())), dtype=np.uint64)


def whole(words: int) -> str:
    """The mask of an item that is found as a whole."""
    return "1" * words


def seeds(ids: np.ndarray, masks: Sequence[str] = MASKS) -> list[np.ndarray]:
    """For each mask the seed of every start; runs of one repeated seed keep their two ends.

    Dropped starts are marked 0. A repetitive text against a repetitive item would else hit at every
    pair of positions; aligning ends with ends already gives the longest overlap.
    """
    out = []
    for mask in masks:
        n = len(ids) - len(mask) + 1
        if n <= 0:
            out.append(np.empty(0, dtype=np.uint64))
            continue
        seed = np.full(n, int("1" + mask, 2), dtype=np.uint64)
        for k, kept in enumerate(mask):
            if kept == "1":
                seed += ids[k : k + n] * MIX[k]
        seed ^= seed >> np.uint64(29)
        seed *= MIX[0]
        seed ^= seed >> np.uint64(32)
        inner = np.zeros(n, dtype=bool)
        inner[1:-1] = (seed[1:-1] == seed[:-2]) & (seed[1:-1] == seed[2:])
        seed[inner] = 0
        out.append(seed)
    return out


def probes(seed: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    size = np.uint64((1 << bits) - 1)
    return (seed >> np.uint64(64 - bits)).astype(np.int64), (seed & size).astype(np.int64)


def _item_tokens(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    ids = TokenIds()
    for batch in batches:
        tokens = [ids.of(t or "").view(np.int64) for t in batch["text"]]
        # A few characters of a script without spaces are a word or two, not an item.
        short = [len(w) in SHORT and not CHARACTER.search(t) for w, t in zip(tokens, batch["text"], strict=True)]
        yield pd.DataFrame({"item_id": batch["item_id"].to_numpy(), "item_tokens": tokens, "short": short})


def _item_seeds(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for item, tokens, short in zip(batch["item_id"], batch["item_tokens"], batch["short"], strict=True):
            masks = [whole(len(tokens))] if short else MASKS if len(tokens) >= SPAN else []
            for found in seeds(np.asarray(tokens, dtype=np.int64).view(np.uint64), masks):
                at = np.flatnonzero(found)
                one, two = probes(found[at], FILTER_BITS)
                yield pd.DataFrame({"item_id": item, "q": at, "seed": found[at].view(np.int64), "one": one, "two": two})


def seed_filter(item_seeds: DataFrame) -> np.ndarray:
    """2^FILTER_BITS bits, two per seed; as 64-bit words, at most 2^(FILTER_BITS - 6) of them."""
    bit = item_seeds.select(F.explode(F.array("one", "two")).alias("bit"))
    word = bit.groupBy(F.shiftright("bit", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 AS int))")).alias("value")
    )
    found = word.toArrow()
    out = np.zeros(1 << (FILTER_BITS - 6), dtype=np.int64)
    out[found["word"].to_numpy()] = found["value"].to_numpy()
    return out.view(np.uint8)


def _passing(ids: np.ndarray, doc: np.ndarray, bitmap: np.ndarray, masks: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Starts and seeds that the filter lets through; ``doc`` numbers each word's document."""
    starts, found = [], []
    for mask, seed in zip(masks, seeds(ids, masks), strict=True):
        one, two = probes(seed, FILTER_BITS)
        at = np.flatnonzero((bitmap[one >> 3] >> (one & 7).astype(np.uint8)) & 1)
        two = two[at]
        at = at[((bitmap[two >> 3] >> (two & 7).astype(np.uint8)) & 1).astype(bool)]
        at = at[(doc[at] == doc[at + len(mask) - 1]) & (seed[at] != 0)]
        starts.append(at)
        found.append(seed[at])
    return np.concatenate(starts), np.concatenate(found)


def _scan(bitmap_of, masks: Sequence[str]) -> object:
    schema = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("segment", pa.int64()),
                        ("tokens", pa.list_(pa.int64())), ("at", pa.list_(pa.int32())), ("seeds", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap, ids = bitmap_of.value, TokenIds()
        for batch in batches:
            rows = []
            for first, texts in slices(x.as_py() for x in batch["text"]):
                each = [ids.of(t) for t in texts]
                sizes = np.array([len(x) for x in each])
                flat = np.concatenate(each)
                doc = np.repeat(np.arange(len(each)), sizes)
                at, found = _passing(flat, doc, bitmap, masks)
                order = np.argsort(at, kind="stable")
                at, found = at[order], found[order]
                if not len(at):
                    continue
                cut = np.flatnonzero((np.diff(at) > 2 * CONTEXT) | (np.diff(doc[at]) > 0)) + 1
                begins = np.concatenate([[0], np.cumsum(sizes)])
                for a, b in zip([0, *cut], [*cut, len(at)], strict=True):
                    d = doc[at[a]]
                    low, high = max(begins[d], at[a] - CONTEXT), min(begins[d + 1], at[b - 1] + SPAN + CONTEXT)
                    tokens = flat[low:high].view(np.int64)
                    row = first + int(d)
                    name = f"{batch['doc_id'][row]} {batch['text_hash'][row]} {low - begins[d]}"
                    rows.append((batch["doc_id"][row].as_py(), batch["text_hash"][row].as_py(),
                                 int(np.uint64(xxhash.xxh64_intdigest(name)).view(np.int64)), tokens,
                                 (at[a:b] - low).astype(np.int32), found[a:b].view(np.int64)))
            for part in range(0, len(rows), 1000):
                columns = list(zip(*rows[part : part + 1000], strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
                )

    return run


def longest_overlap(same: np.ndarray, share: float) -> tuple[int, int]:
    """Length of the longest stretch with at least ``share`` True, and how many are."""
    gain = np.where(same, 1.0 - share, -share)
    sums = np.round(np.concatenate([[0.0], np.cumsum(gain)]), 9)
    first = np.searchsorted(-np.minimum.accumulate(sums), -sums, side="left")
    spans = np.arange(len(sums)) - first
    end = int(spans.argmax())
    return int(spans[end]), int(same[first[end] : end].sum())


def _verify(share: float, least: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for tokens, item, shift in zip(batch["tokens"], batch["item_tokens"], batch["shift"], strict=True):
                low, high = max(0, shift), min(len(tokens), shift + len(item))
                overlap = (0, 0)
                if high > low:
                    overlap = longest_overlap(np.asarray(tokens[low:high]) == np.asarray(item[low - shift : high - shift]), share)
                found.append(overlap if overlap[0] >= min(least, len(item)) else (0, 0))
            out = batch[["doc_id", "text_hash", "item_id"]].assign(
                overlap=[x[0] for x in found], matched=[x[1] for x in found]
            )
            yield out[out["overlap"] > 0]

    return run


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    share: float = SHARE,
    least: int = WORDS,
    columns: Sequence[str] = ("doc_id", "text"),
) -> DataFrame:
    """One row per document and benchmark item that overlap: doc_id, text_hash, item_id, overlap, matched.

    Words are runs of letters, digits and underscores, compared in lower case, and single characters in scripts
    without spaces. An overlap has at least
    ``least`` words (the whole item if that is shorter) of which at least ``share`` agree. Items of equal
    words are one class, named by the smallest item_id. Items of five to nine words are found only verbatim;
    items under five words, or under ten characters of a script without spaces, are no evidence and never
    found; NULL and empty texts hold none. Repeated documents and documents with a NULL id are found by
    id and text together. Empty tables give no rows; further columns are ignored.
    """
    doc_id, text = columns
    spark = docs.sparkSession
    items = take(benchmark, "item_id", "text").select(F.col("item_id").cast("long").alias("item_id"), "text")
    items = items.mapInPandas(_item_tokens, "item_id long, item_tokens array<long>, short boolean")
    items = items.groupBy("item_tokens").agg(F.min("item_id").alias("item_id"), F.max("short").alias("short"))
    items = stored(items.select("item_id", "item_tokens", "short"), "benchmark-items")
    lengths = items.filter("short").select(F.size("item_tokens").alias("n")).distinct().orderBy("n").collect()  # at most len(SHORT)
    masks = [*MASKS, *[whole(r.n) for r in lengths]]
    item_seeds = stored(items.mapInPandas(_item_seeds, "item_id long, q int, seed long, one long, two long"), "benchmark-seeds")
    bitmap = spark.sparkContext.broadcast(seed_filter(item_seeds))

    picked = take(docs, doc_id, text).select(
        F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), F.col(text).alias("text")
    )
    segments = stored(
        picked.mapInArrow(
            _scan(bitmap, masks), "doc_id long, text_hash long, segment long, tokens array<long>, at array<int>, seeds array<long>"
        ),
        "benchmark-segments",
    )
    hits = segments.select("segment", F.explode(F.arrays_zip("at", "seeds")).alias("hit")).select(
        "segment", F.col("hit.at").alias("at"), F.col("hit.seeds").alias("seed")
    )
    shifts = (
        hits.join(item_seeds.select("seed", "item_id", "q"), "seed")
        .select("segment", "item_id", (F.col("at") - F.col("q")).alias("shift"))
        .distinct()
    )
    laid = shifts.join(segments.drop("at", "seeds").dropDuplicates(["segment"]), "segment").join(items.drop("short"), "item_id")
    found = laid.select("doc_id", "text_hash", "tokens", "item_id", "item_tokens", "shift").mapInPandas(
        _verify(share, least), "doc_id long, text_hash long, item_id long, overlap int, matched int"
    )
    return found.groupBy("doc_id", "text_hash", "item_id").agg(F.max("overlap").alias("overlap"), F.max("matched").alias("matched"))


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents, all columns, that overlap no benchmark item.

    NULL and empty texts overlap nothing and stay; so does everything where there are no items. Rows equal in id and text
    share their fate; an empty table gives no rows. Further columns stay, whatever their names.
    """
    return without(docs, contaminated(docs, benchmark), "benchmark-leaks")
