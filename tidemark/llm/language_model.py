"""A log-bilinear language model, trained in numpy with noise-contrastive estimation.

Every word belongs to a class: frequent words are their own class, rarer ones share classes by their
first and last letters, and the end of a text is a class. A class's score after another is the product
of their vectors plus a bias. Because the number of classes is fixed, all that training needs of the
corpus is how often each class follows each: counted over all training texts, at most classes^2 cells.
Noise-contrastive estimation then works on those counts with its expectation over the noise exact, and
one matrix product gives every normalised log-probability. A word's probability is its class's, times
its smoothed share of the class's words.

Word counts stay on the cluster. The most frequent words (a bounded list) are broadcast; each
document's other words meet their counts in a join.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import crc_remainder, stored, take, words

OWN, SHARED = 1200, 256
HEAD = 1 << 17
DIMENSIONS, NOISE, ROUNDS, RATE = 32, 10, 150, 0.05
# Variance of the Gaussian prior of the vectors: it weighs little in a large corpus and much in a small one.
PRIOR = 0.1
HELD_WORDS = 200_000
CLASSES = OWN + SHARED + 1
END = OWN + SHARED


def shared_class(word: str) -> int:
    ends = word[0] + word[-2:]
    return OWN + zlib.crc32(ends.encode("utf-8", "surrogatepass")) % SHARED


def _shared_class(word: Column) -> Column:
    ends = F.concat(F.left(word, F.lit(1)), F.right(word, F.lit(2)))
    return (F.crc32(ends.cast("binary")) % SHARED + OWN).cast("int")


def train(counts: np.ndarray, dimensions: int = DIMENSIONS, noise: int = NOISE, rounds: int = ROUNDS, rate: float = RATE) -> np.ndarray:
    """Normalised natural log-probabilities of class after class, from counts of class pairs.

    The objective: sum of n(i,v) log s(d) + n(i) k q(v) log s(-d), with d the score less log(k q(v)).
    """
    n = len(counts)
    rows, columns = counts.sum(axis=1, dtype=np.float64), counts.sum(axis=0, dtype=np.float64)
    total = max(rows.sum(), 1.0)
    q = (columns + 1) / (columns.sum() + n)
    rng = np.random.default_rng(17)
    bias = np.log(q).astype(np.float32)
    left, right = (rng.normal(scale=0.1, size=(n, dimensions)).astype(np.float32) for _ in range(2))
    share = (counts / total).astype(np.float32)
    push = (np.outer(rows / total, noise * q)).astype(np.float32)
    shift = np.log(noise * q).astype(np.float32)
    held = np.float32(1 / (PRIOR * total))
    state = [(x, np.zeros_like(x), np.zeros_like(x)) for x in (left, right, bias)]
    for step in range(1, rounds + 1):
        s = 1 / (1 + np.exp(-(left @ right.T + (bias - shift))))
        slope = share * (1 - s) - push * s
        slopes = (slope @ right - held * left, slope.T @ left - held * right, slope.sum(axis=0))
        for (x, mean, square), g in zip(state, slopes, strict=True):
            mean += 0.1 * (g - mean)
            square += 0.01 * (g * g - square)
            x += rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-9)
        if step == rounds * 2 // 3:
            rate /= 5
    logits = left @ right.T + bias
    logits -= logits.max(axis=1, keepdims=True)
    return (logits - np.log(np.exp(logits, dtype=np.float32).sum(axis=1, keepdims=True))).astype(np.float32)


def count_words(docs: DataFrame) -> DataFrame:
    """word and n over all texts. Each task adds up words before they are shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in batches:
            for text in batch["text"]:
                held.update(words(text.as_py()))
                if len(held) > HELD_WORDS:
                    yield pa.RecordBatch.from_pydict({"word": pa.array(list(held), pa.string()), "n": pa.array(list(held.values()), pa.int64())})
                    held.clear()
        yield pa.RecordBatch.from_pydict({"word": pa.array(list(held), pa.string()), "n": pa.array(list(held.values()), pa.int64())})

    return docs.select("text").mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def frequent(counts: DataFrame, most: int) -> int:
    """The smallest count that at most ``most`` words reach. Only counts of counts come to the driver."""
    step = F.floor(F.log2(F.col("n").cast("double")) * 16)
    bands = counts.groupBy(step.alias("band")).agg(F.count(F.lit(1)).alias("words"), F.max("n").alias("top")).collect()
    least, taken = None, 0
    for band in sorted(bands, key=lambda b: -b["band"]):
        if taken + band["words"] > most:
            break
        taken, least = taken + band["words"], band["band"]
    if least is None:
        return max((b["top"] for b in bands), default=0) + 1
    return int(counts.filter(step >= least).agg(F.min("n")).first()[0])


class _Places(dict):
    """Word to place: listed words first; others are given the next place and their class."""

    def __init__(self, listed: Sequence[str], classes: Sequence[int]) -> None:
        super().__init__((w, i) for i, w in enumerate(listed))
        self.listed, self.classes = len(self), list(classes)
        self.others: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = place = len(self.classes)
        self.classes.append(shared_class(word))
        self.others.append(word)
        return place

    def forget(self) -> None:
        if len(self.others) > HELD_WORDS:
            for word in self.others:
                del self[word]
            self.others.clear()
            del self.classes[self.listed :]


@dataclass
class Model:
    """listed words with their classes and log10(count + 1); table: log10 of class after class."""

    listed: list[str]
    classes: list[int]
    logs: np.ndarray
    table: np.ndarray
    sums: np.ndarray  # per class log10 of what its words' shares are divided by


def _pairs(shared) -> object:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        listed, classes = shared.value
        places = _Places(listed, classes)
        total = np.zeros(CLASSES * CLASSES, dtype=np.int64)
        held: list[np.ndarray] = []

        def add() -> None:
            of = np.array(places.classes, dtype=np.int64)
            flat = np.concatenate(held)
            kind = np.where(flat < 0, END, of[flat])
            np.add(total, np.bincount(kind[:-1] * CLASSES + kind[1:], minlength=len(total)), out=total)
            held.clear()
            places.forget()

        size = 0
        for batch in batches:
            for text in batch["text"]:
                # Every text begins after an end and has its own.
                found = np.array([-1, *map(places.__getitem__, words(text.as_py())), -1], dtype=np.int64)
                held.append(found)
                size += len(found)
                # The end of one text and the start mark of the next are a pair of no text.
                total[END * CLASSES + END] -= len(held) > 1
                if size > 1_000_000:
                    add()
                    size = 0
        if held:
            add()
        cells = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"cell": cells, "n": total[cells]})

    return run


def _score(shared) -> object:
    columns = ("doc_id", "held_out", "n_tokens", "n_known", "logs", "shared_logs", "model")
    types = (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64())
    nothing = (None,) * len(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        places = _Places(model.listed, model.classes)
        end_log = model.logs[-1]
        for batch in batches:
            row_ids, keys, counts, infos = [], [], [], []

            def flush() -> pa.RecordBatch:
                fields = [pa.array(c, t) for c, t in zip(zip(*infos, strict=True), types, strict=True)]
                marks = pa.array(np.array(keys, dtype=np.uint64).view(np.int64))
                out = pa.RecordBatch.from_arrays(
                    [pa.array(row_ids, pa.int64()), marks, pa.array(counts, pa.int32()), *fields], ["row", "key", "n", *columns]
                )
                for x in (row_ids, keys, counts, infos):
                    x.clear()
                return out

            for row, doc_id, held, text in zip(batch["row"].to_pylist(), batch["doc_id"].to_pylist(), batch["held_out"].to_pylist(), batch["text"], strict=True):
                at = np.array([places[w] for w in words(text.as_py())], dtype=np.int64)
                of = np.array([places.classes[i] for i in at.tolist()], dtype=np.int64)
                chain = np.concatenate([[END], of, [END]])
                listed = at[at < places.listed]
                rare = of >= OWN
                logs = model.logs[listed]
                own = float(model.table[chain[:-1], chain[1:]].sum(dtype=np.float64)) - float(model.sums[of[rare]].sum())
                infos.append((doc_id, held, len(at) + 1, len(listed) + int(end_log > 0), float(logs.sum()) + end_log,
                              float(logs[of[at < places.listed] >= OWN].sum()), own))
                row_ids.append(row), keys.append(xxhash.xxh64_intdigest(str(row), 1)), counts.append(0)
                tail, n = np.unique(at[at >= places.listed], return_counts=True)
                for place, many in zip(tail.tolist(), n.tolist(), strict=True):
                    row_ids.append(row), infos.append(nothing), counts.append(many)
                    keys.append(xxhash.xxh64_intdigest(places.others[place - places.listed].encode("utf-8", "surrogatepass"), 42))
                places.forget()
                if len(keys) > 100_000:
                    yield flush()
            if keys:
                yield flush()

    return run


def score(
    docs: DataFrame, modulus: int = 7, held: int = 2, head: int = HEAD, columns: Sequence[str] = ("doc_id", "text")
) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Learns from rows whose crc32(doc_id) modulo ``modulus`` is not ``held``. NULL and empty texts are the
    end token alone. Without training texts nothing is known, base_score is 0 and the model uniform over
    classes. Repeated rows each get their row; an empty table gives none. Further columns are ignored.
    Words beyond the broadcast list meet their counts by 64-bit hash.
    """
    spark = docs.sparkSession
    picked = take(docs, *columns).toDF("doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    picked = picked.withColumn("held_out", crc_remainder("doc_id", modulus) == held)
    training = picked.filter(~F.col("held_out")).select("text")
    counts = stored(count_words(training), "word-counts")
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    ends = training.count()
    n_tokens, n_types = total + ends, distinct + (ends > 0)

    least = frequent(counts, head)
    top = counts.filter(F.col("n") >= least).select("word", "n").toArrow()  # at most ``head`` rows
    order = sorted(zip(top["word"].to_pylist(), top["n"].to_pylist(), strict=True), key=lambda x: (-x[1], x[0]))
    listed, listed_n = [w for w, _ in order], np.array([n for _, n in order], dtype=np.float64)
    classes = [i if i < OWN else shared_class(w) for i, w in enumerate(listed)]

    follows = training.mapInArrow(_pairs(spark.sparkContext.broadcast((listed, classes))), "cell long, n long")
    cells = follows.groupBy("cell").agg(F.sum("n").alias("n")).toArrow()  # at most CLASSES^2 rows
    pairs = np.zeros(CLASSES * CLASSES)
    pairs[cells["cell"].to_numpy()] = cells["n"].to_numpy()
    pairs = pairs.reshape(CLASSES, CLASSES)
    kinds = counts.groupBy(_shared_class(F.col("word")).alias("c")).agg(F.count(F.lit(1)).alias("n")).collect()  # SHARED rows
    types = np.zeros(CLASSES)
    for r in kinds:
        types[r["c"]] = r["n"]
    for w in listed[:OWN]:
        types[shared_class(w)] -= 1
    sums = np.log10(pairs.sum(axis=0) + types + 1)
    logs = np.log10(np.append(listed_n, ends) + 1)
    model = Model(listed, classes, logs, train(pairs) / np.float32(np.log(10)), sums)

    shared = spark.sparkContext.broadcast(model)
    rows = picked.select(F.monotonically_increasing_id().alias("row"), "doc_id", "held_out", "text")
    told = "doc_id long, held_out boolean, n_tokens long, n_known long, logs double, shared_logs double, model double"
    scored = rows.mapInArrow(_score(shared), f"row long, key long, n int, {told}")
    tail = counts.filter(F.col("n") < least).select(F.xxhash64("word").alias("key"), F.col("n").alias("c"))
    met = scored.join(tail, "key", "left")
    # The one row with n_tokens tells of the document itself; its key is random, to spread those rows.
    known = F.col("n_tokens").isNull() & F.col("c").isNotNull()
    per = met.groupBy("row").agg(
        *[F.max(c).alias(c) for c in ("doc_id", "held_out", "n_tokens", "n_known", "logs", "shared_logs", "model")],
        F.sum(F.when(known, F.col("n")).otherwise(0)).alias("tail_known"),
        F.sum(F.when(known, F.col("n") * F.log10(F.col("c") + 1)).otherwise(0.0)).alias("tail_logs"),
    )
    unit = F.lit(float(np.log10(n_tokens + n_types + 1)))
    return per.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.col("tail_known")).alias("n_known"),
        F.lit(n_tokens).cast("long").alias("train_tokens"),
        (F.col("logs") + F.col("tail_logs") - F.col("n_tokens") * unit).alias("base_score"),
        (F.col("model") + F.col("shared_logs") + F.col("tail_logs")).alias("score"),
    )
