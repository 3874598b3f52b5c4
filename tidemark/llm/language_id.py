"""Language identification by interpolated Kneser-Ney character models.

Each language has its own 4-gram model over the characters of words, counted over all its training
texts; lower orders count the different characters that precede them. Probabilities lie in sorted
arrays of 64-bit gram hashes, each with the languages that know the gram. Grams are counted and joined as
themselves (21 bits a character); two of a hundred million different ones share a hash in one corpus of some
four thousand.

The most frequent grams, ``HELD_ENTRIES`` entries at most, are broadcast. If there are more, the rest stays a
table: documents are cut into slices of bounded size, each slice asks for the grams it misses by an equi-join, and is
judged with what came back. The result is the same, whatever the bound.

A text gets the language of the lowest cross-entropy per character, and is rejected if that entropy is beyond what
training texts of the language show.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import SLICE_CHARS, crc_remainder, slices, stored, take, without

ORDER = 4
CHAR_BITS = 21
ONE_CHAR = (1 << CHAR_BITS) - 1
LETTERS = re.compile(r"[^\W\d_]+")
START, END = "\x02", "\x03"
HELD_WORDS = 200_000
# A gram's probability under one language takes 6 bytes, a gram 16 more: some 100 MB in every Python worker.
HELD_ENTRIES = 1 << 23
# Characters of words, times languages, that are scored at a time: some 20 MB in a Python worker, at a tenth more time than with four times as many.
CELLS = 500_000
CERTAIN_CHARS = 30
FAR = 8.0
UNDETERMINED = "und"
# Kinds of model rows: 1 to ORDER are a gram's discounted share, ORDER + k the weight that a context of order k gives to the lower order.
MISSING = {kind: 0.0 if kind <= ORDER else 1.0 for kind in range(1, 2 * ORDER + 1)}


def _grams(words: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of every gram of full order (grams x order), and each gram's word."""
    text = "".join(START * (ORDER - 1) + w + END for w in words)
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
    at = np.flatnonzero(codes != ord(START))
    word = np.concatenate([[0], np.cumsum(codes == ord(END))])[at]
    return np.stack([codes[at - k] for k in range(ORDER - 1, -1, -1)], axis=1), word


def _packed(chars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """At most four characters as two numbers: all but the last two, and the last two."""
    halves = [np.zeros(len(chars), dtype=np.int64), np.zeros(len(chars), dtype=np.int64)]
    for k in range(chars.shape[1]):
        half = int(chars.shape[1] - k <= 2)
        halves[half] = (halves[half] << CHAR_BITS) | chars[:, k]
    return halves[0], halves[1]


def _hashed(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """64 bits of a gram; of grams that differ in their last two characters only, always different ones."""

    def mix(x: np.ndarray) -> np.ndarray:
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))

    return mix(mix(high.astype(np.uint64) + np.uint64(1)) + low.astype(np.uint64))


def _different(words: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different grams of the words; per gram of the words its place among them, and its word."""
    chars, word = _grams(words)
    _, first, place = np.unique(_hashed(*_packed(chars)), return_index=True, return_inverse=True)
    return chars[first], place, word


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Grams of the words of each language, added up for a bounded number of words at a time."""

    def flush(lang: str, words: Counter) -> pa.RecordBatch:
        listed = list(words)
        chars, word = _grams(listed)
        high, low = _packed(chars)
        order = np.lexsort((low, high))
        high, low = high[order], low[order]
        first = np.flatnonzero(np.concatenate([[True], (np.diff(high) != 0) | (np.diff(low) != 0)]))
        n = np.add.reduceat(np.array([words[w] for w in listed], dtype=np.int64)[word[order]], first)
        return pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(first), pa.string()), "high": high[first], "low": low[first], "n": n})

    for batch in batches:
        held: dict[str, Counter] = {}
        for lang, text in zip(batch["lang"], batch["text"], strict=True):
            lang, words = lang.as_py(), held.setdefault(lang.as_py(), Counter())
            words.update(LETTERS.findall((text.as_py() or "").lower()))
            if len(words) > HELD_WORDS:
                yield flush(lang, held.pop(lang))
        for lang, words in held.items():
            if words:
                yield flush(lang, words)


@dataclass
class Grams:
    """Sorted gram hashes; the languages that know gram i, and their values, lie from start[i] to start[i + 1]."""

    keys: np.ndarray
    start: np.ndarray
    langs: np.ndarray
    values: np.ndarray

    def fill(self, out: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """Writes the values of known grams (rows) under their languages (columns); says which grams are known."""
        if not len(self.keys):
            return np.zeros(len(hashes), dtype=bool)
        at = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
        known = self.keys[at] == hashes
        rows = np.flatnonzero(known)
        begin = self.start[at[rows]]
        many = self.start[at[rows] + 1] - begin
        entry = np.repeat(begin - (np.cumsum(many) - many), many) + np.arange(many.sum())
        out[np.repeat(rows, many), self.langs[entry]] = self.values[entry]
        return known


def _tables(rows: pa.Table) -> dict[int, Grams]:
    """Model rows (kind, high, low, langs, values) as arrays, per kind."""
    out = {}
    kinds = rows["kind"].to_numpy()
    for kind in np.unique(kinds):
        part = rows.filter(pa.array(kinds == kind)).combine_chunks()
        hashes = _hashed(part["high"].to_numpy(), part["low"].to_numpy())
        order = np.argsort(hashes)
        part = part.take(pa.array(order))
        langs, values = part["langs"].combine_chunks(), part["values"].combine_chunks()
        start = np.concatenate([[0], np.cumsum(langs.value_lengths().to_numpy())])
        out[int(kind)] = Grams(hashes[order], start, langs.flatten().to_numpy().astype(np.uint16), values.flatten().to_numpy().astype(np.float32))
    return out


@dataclass
class Model:
    """Languages, the probability of any character, and the grams at hand; ``rest`` are the others, as a table (None: there are none)."""

    langs: list[str]
    floor: float
    held: dict[int, Grams]
    rest: DataFrame | None = None

    def shipped(self) -> Model:
        return Model(self.langs, self.floor, self.held)

    @staticmethod
    def _wanted(chars: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        for k in range(1, ORDER + 1):
            yield k, *_packed(chars[:, ORDER - k :])
            yield ORDER + k, *_packed(chars[:, ORDER - k : ORDER - 1])

    def missed(self, words: Sequence[str]) -> pd.DataFrame:
        """Different (kind, high, low) of the words that are not at hand."""
        out = []
        chars, _, _ = _different(words)
        for kind, high, low in self._wanted(chars):
            table = self.held.get(kind)
            found = np.isin(_hashed(high, low), table.keys) if table else np.zeros(len(high), dtype=bool)
            out.append(pd.DataFrame({"kind": np.int32(kind), "high": high[~found], "low": low[~found]}).drop_duplicates())
        return pd.concat(out)

    def probabilities(self, chars: np.ndarray, further: dict[int, Grams] | None = None) -> np.ndarray:
        """Of the last character of every gram (rows) after the others, under each language (columns)."""
        shape = (len(chars), len(self.langs))
        p = np.full(shape, self.floor)
        values = {}
        for kind, high, low in self._wanted(chars):
            values[kind] = np.full(shape, MISSING[kind])
            hashes = _hashed(high, low)
            for tables in (self.held, further or {}):
                if kind in tables:
                    tables[kind].fill(values[kind], hashes)
            if kind > ORDER:
                p = values.pop(kind - ORDER) + values.pop(kind) * p
        return p

    def entropies(self, words: Sequence[str], further: dict[int, Grams] | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Per word its negative log-probability under each language, and its number of characters."""
        n = len(self.langs)
        total, chars_of = np.zeros((len(words), n)), np.zeros(len(words))
        for at, end in _runs(words, CELLS // n):
            chars, place, word = _different(words[at:end])
            cost = -np.log(np.maximum(self.probabilities(chars, further), 1e-12))
            for j in range(n):
                total[at:end, j] = np.bincount(word, cost[place, j], end - at)
            chars_of[at:end] = np.bincount(word, minlength=end - at)
        return total, chars_of


def _runs(words: Sequence[str], chars: int) -> Iterator[tuple[int, int]]:
    """Stretches of words of about so many characters."""
    start, held = 0, 0
    for i, w in enumerate(words):
        held += len(w) + 1
        if held >= chars:
            yield start, i + 1
            start, held = i + 1, 0
    if start < len(words):
        yield start, len(words)


def _level(weight: str) -> Column:
    """Binary digits of a count."""
    return F.length(F.bin(weight))


def fit(docs: DataFrame, held: int = HELD_ENTRIES) -> Model | None:
    """Count and smooth on the cluster; at most ``held`` probabilities, those of the most frequent grams, come to the driver.

    docs: lang (not NULL) and text. None if there is nothing to learn from.
    """
    counts = docs.mapInArrow(_count, "lang string, high long, low long, n long")
    named = stored(counts.groupBy("lang", "high", "low").agg(F.sum("n").alias("n")), "char-grams")
    langs = sorted(r["lang"] for r in named.select("lang").distinct().collect())
    if not langs:
        return None
    # One row per language. From here on languages are numbers: a broadcast keyed by text takes a whole memory page of every
    # executor, however few its rows, and there is one for each join with something per language.
    column = F.broadcast(docs.sparkSession.createDataFrame(list(enumerate(langs)), "at int, lang string"))
    tables = {ORDER: named.join(column, "lang").select("at", "high", "low", "n")}
    for order in range(ORDER - 1, 0, -1):
        # Continuation counts: how many different characters precede the shorter gram.
        high = F.col("high").bitwiseAND(ONE_CHAR) if order == 3 else F.lit(0).cast("long")
        low = F.col("low").bitwiseAND(ONE_CHAR) if order == 1 else F.col("low")
        shorter = tables[order + 1].groupBy("at", high.alias("high"), low.alias("low"))
        tables[order] = stored(shorter.agg(F.count(F.lit(1)).alias("n")), "char-grams")
    alphabet = tables[1].select("low").distinct().count()
    # Order by order, as no gram has rows of two: a query of all orders starts dozens of stages and broadcasts at once, whose
    # buffers are what the driver's heap grows by.
    parts = [_known(*_smoothed(grams, order)) for order, grams in tables.items()]
    model = stored(parts[0], "char-model")
    for part in parts[1:]:
        model = model.union(stored(part, "char-model"))
    sizes = model.groupBy(_level("weight").alias("level")).agg(F.sum(F.size("langs")).alias("n")).orderBy(F.desc("level")).collect()
    least, room = 1 + sizes[0]["level"], held
    for r in sizes:
        room -= r["n"]
        if room < 0:
            break
        least = r["level"]
    narrow = model.select("kind", "high", "low", "langs", "values")
    frequent = _level("weight") >= least
    rest = None if room >= 0 else model.filter(~frequent).select(*narrow.columns)
    return Model(langs, 1.0 / (alphabet + 1), _tables(narrow.filter(frequent).toArrow()), rest)


def _smoothed(grams: DataFrame, order: int) -> tuple[DataFrame, DataFrame]:
    """Model rows of an order: at (the language), kind, high, low, value, weight, of its grams and of its contexts."""
    ones = grams.groupBy("at").agg(F.sum((F.col("n") == 1).cast("long")).alias("n1"), F.sum((F.col("n") == 2).cast("long")).alias("n2"))
    off = F.when((F.col("n1") > 0) & (F.col("n2") > 0), F.col("n1") / (F.col("n1") + 2 * F.col("n2"))).otherwise(F.lit(0.75))
    ones = ones.select("at", off.alias("off"))
    above = F.shiftright("high", CHAR_BITS)
    below = F.shiftleft(F.col("high").bitwiseAND(ONE_CHAR), CHAR_BITS).bitwiseOR(F.shiftright("low", CHAR_BITS))
    grams = grams.withColumns({"above": above, "below": below})
    contexts = grams.groupBy("at", "above", "below").agg(F.sum("n").alias("all"), F.count(F.lit(1)).alias("kinds"))
    # One row per language and one per context: small and medium sides that Spark places by size.
    contexts = contexts.join(ones, "at")
    share = ((F.col("n") - F.col("off")) / F.col("all")).cast("float").alias("value")
    passed = (F.col("off") * F.col("kinds") / F.col("all")).cast("float").alias("value")
    if order < ORDER:
        # At most two characters and the language's number fit one number, and few of these contexts are broadcast.
        one = (F.shiftleft(F.col("at").cast("long"), 2 * CHAR_BITS) + F.col("below")).alias("context")
        met = grams.select("at", "high", "low", "n", one).join(contexts.select(one, "off", "all", "kinds"), "context")
    else:
        met = grams.join(contexts, ["at", "above", "below"])
    direct = met.select("at", F.lit(order).alias("kind"), "high", "low", share, F.col("n").alias("weight"))
    return direct, contexts.select(
        "at", F.lit(ORDER + order).alias("kind"), F.col("above").alias("high"), F.col("below").alias("low"), passed, F.col("all").alias("weight")
    )


def _known(direct: DataFrame, contexts: DataFrame) -> DataFrame:
    """Per kind and gram the languages that know it and their values."""
    per_gram = direct.union(contexts).groupBy("kind", "high", "low")
    per_gram = per_gram.agg(F.collect_list(F.struct("at", "value")).alias("known"), F.max("weight").alias("weight"))
    return per_gram.select("kind", "high", "low", F.col("known.at").alias("langs"), F.col("known.value").alias("values"), "weight")


class _Words(dict):
    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        return n


def _judged(model: Model, texts: Sequence[str], further: dict[int, Grams] | None = None) -> pd.DataFrame:
    """Language, score, entropy and number of characters of each text."""
    words = _Words()
    each = [np.array([words[w] for w in LETTERS.findall(t.lower())], dtype=np.int64) for t in texts]
    listed = list(words)
    lettered = np.array([any(c.isalpha() for c in w) for w in listed], dtype=bool)
    total, chars = model.entropies(listed, further)
    flat = np.concatenate(each) if each else np.empty(0, dtype=np.int64)
    doc = np.repeat(np.arange(len(each)), [len(x) for x in each])
    length = np.bincount(doc, chars[flat], len(each))
    some = np.bincount(doc, lettered[flat], len(each)) > 0
    mean = np.stack([np.bincount(doc, total[flat, j], len(each)) for j in range(total.shape[1])], axis=1)
    mean = mean / np.maximum(length, 1)[:, None]
    best = mean.argmin(axis=1)
    low = mean[np.arange(len(each)), best]
    odds = np.exp(-(mean - low[:, None]) * np.minimum(length, CERTAIN_CHARS)[:, None])
    named = np.where(some, np.array(model.langs, dtype=object)[best], UNDETERMINED)
    found = {"lang_pred": named, "score": np.where(some, 1 / odds.sum(axis=1), 0.0), "entropy": np.where(some, low, np.nan), "chars": length.astype(np.int64)}
    return pd.DataFrame(found)


JUDGED = "lang_pred string, score double, entropy double, chars long"


def _beside(kept: Sequence[pa.Array], names: Sequence[str], found: Sequence[pd.DataFrame]) -> pa.Table:
    """The kept columns with what was found."""
    table = pd.concat(found) if found else pd.DataFrame({"lang_pred": [], "score": [], "entropy": [], "chars": []})
    new = [
        pa.array(table["lang_pred"], pa.string()), pa.array(table["score"], pa.float64()), pa.array(table["entropy"], pa.float64(), from_pandas=True),
        pa.array(table["chars"].to_numpy().astype(np.int64)),
    ]
    return pa.Table.from_arrays([*kept, *new], [*names, *table.columns])


def _judge(shared) -> object:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_judged(shared.value, texts) for _, texts in slices(x.as_py() for x in batch["text"])]
            names = [c for c in batch.schema.names if c != "text"]
            yield from _beside([batch[c] for c in names], names, found).to_batches()

    return run


def _sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Numbers slices of about the same number of characters; a number names its task too."""
    task, n, chars = TaskContext.get().partitionId(), 0, 0
    for batch in batches:
        numbers = []
        for text in batch["text"]:
            numbers.append((task << 32) | n)
            chars += len(text.as_py() or "")
            if chars >= SLICE_CHARS:
                n, chars = n + 1, 0
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(numbers, pa.int64())], [*batch.schema.names, "slice"])


def _misses(shared) -> object:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch["slice"].to_numpy()
            for number in np.unique(at):
                texts = batch["text"].filter(pa.array(at == number))
                words = list({w for x in texts for w in LETTERS.findall((x.as_py() or "").lower())})
                wanted = [shared.value.missed(words[start:end]) for start, end in _runs(words, CELLS)]
                if wanted:
                    out = pd.concat(wanted).drop_duplicates()
                    yield pa.RecordBatch.from_pandas(out.assign(slice=number)[["slice", "kind", "high", "low"]], preserve_index=False)

    return run


def _scores(rows: DataFrame, model: Model, kept: str) -> DataFrame:
    """rows (with text) judged; grams that are not at hand come to the slices that need them."""
    shared = rows.sparkSession.sparkContext.broadcast(model.shipped())
    if model.rest is None:
        return rows.mapInArrow(_judge(shared), f"{kept}, {JUDGED}")
    cut = stored(rows.mapInArrow(_sliced, f"{kept}, text string, slice long"), "language-slices")
    asked = cut.select("slice", "text").mapInArrow(_misses(shared), "slice long, kind int, high long, low long").distinct()
    brought = asked.join(model.rest, ["kind", "high", "low"])
    names = [c for c in rows.columns if c != "text"]

    def judge(docs: pa.Table, grams: pa.Table) -> pa.Table:
        further = _tables(grams) if len(grams) else None
        texts = [t or "" for t in docs["text"].to_pylist()]
        return _beside([docs[c] for c in names], names, [_judged(shared.value, texts, further)] if texts else [])

    return cut.groupBy("slice").cogroup(brought.groupBy("slice")).applyInArrow(judge, f"{kept}, {JUDGED}")


def identify(
    docs: DataFrame, modulus: int = 4, held: int = 2, far: float = FAR, columns: Sequence[str] = ("doc_id", "text", "lang"), entries: int = HELD_ENTRIES
) -> DataFrame:
    """Per row: doc_id, text_hash, held_out, lang_pred, score, entropy, chars, rejected.

    Learns from rows with a language whose crc32(doc_id) modulo ``modulus`` is not ``held``. A NULL text
    and one without letters is ``und`` with score 0 and rejected; so is every row if nothing can be
    learned. Other rows are rejected if their entropy exceeds the mean of the training rows given the
    same language by more than ``far`` deviations; a deviation joins the spread between texts and the
    spread that a text of so few characters shows by chance, both taken from the training rows. Equal entropies go to the language first in
    code-point order. An empty table gives no rows; further columns are ignored. ``entries`` bounds what is broadcast and
    changes no result.
    """
    doc_id, text, lang = columns
    picked = take(docs, doc_id, text, lang).toDF("doc_id", "text", "lang")
    picked = picked.withColumn("doc_id", F.col("doc_id").cast("long"))
    rest = crc_remainder("doc_id", modulus)
    model = fit(picked.filter((rest != held) & F.col("lang").isNotNull()).select("lang", "text"), entries)
    rows = picked.select(
        "doc_id", F.xxhash64("text").alias("text_hash"), (rest == held).alias("held_out"), F.col("lang").isNotNull().alias("labelled"), "text"
    )
    kept = "doc_id long, text_hash long, held_out boolean, labelled boolean"
    if model is None:
        found = rows.drop("text").withColumns(
            {"lang_pred": F.lit(UNDETERMINED), "score": F.lit(0.0), "entropy": F.lit(None).cast("double"), "chars": F.lit(0).cast("long")}
        )
        return found.withColumn("rejected", F.lit(True)).drop("labelled")
    scored = stored(_scores(rows, model, kept), "language-scores")
    trained = scored.filter(~F.col("held_out") & F.col("labelled") & F.col("entropy").isNotNull())
    # One row per language: written, so its size is known to the join.
    means = trained.groupBy("lang_pred").agg(F.avg("entropy").alias("mean"), F.var_pop("entropy").alias("spread"))
    means = stored(means, "language-means")
    off = (F.col("entropy") - F.col("mean")) ** 2 * F.col("chars")
    chance = trained.join(means, "lang_pred").groupBy("lang_pred", "mean", "spread").agg(F.avg(off).alias("chance"))
    limits = stored(chance, "language-limits")
    limit = F.col("mean") + F.lit(far) * F.sqrt(F.col("spread") + F.col("chance") / F.col("chars")) + F.lit(1e-9)
    beyond = F.col("entropy").isNull() | F.coalesce(F.col("entropy") > limit, F.lit(False))
    return scored.join(limits, "lang_pred", "left").select(
        "doc_id", "text_hash", "held_out", "lang_pred", "score", "entropy", "chars", beyond.alias("rejected")
    )


def with_language(docs: DataFrame) -> DataFrame:
    """The documents, all columns, that are not rejected.

    Texts without a letter, NULL and empty ones among them, belong to no language and go, as ``identify`` rejects them. Rows
    equal in id and text share their fate; an empty table gives no rows. Further columns stay, whatever their names.
    """
    return without(docs, identify(docs).filter("rejected"), "language-rejected")
