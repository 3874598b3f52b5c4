"""Runs of periodic words, found through string synchronising sets.

A run is a stretch of words with smallest period q, at least twice q long, that no neighbour extends. Periods are looked
for at dyadic scales t = 1, 2, 4, ...; scale t finds those from 3t to 6t - 1, and 1 and 2 are the small periods below
every scale.

* The synchronising set of scale t holds position i if, of the hashes of the t-word windows at i to i + t, the smallest
  is at i or i + t. Whether a position is in it depends on the 2t words from it alone. Windows inside highly periodic
  regions (period at most t/3, known from smaller scales) don't count, so positions with equal contexts are more than
  t/3 apart and the set is thin.
* A run of period q in the scale's reach holds a synchronising position x such that x + q is one too and has the same
  2t words. (All windows it could have being highly periodic would give the run a smaller period, by Fine and Wilf.) So
  positions of equal context less than 6t apart propose their distance as a period; at most 17 partners each are met.
* A proposed pair is extended in both directions by comparing hashes of windows of falling powers of two. What is shorter
  than two periods goes, and so does what has a smaller period.
* Stretches of equal words one or two apart are the highly periodic regions that no scale sees; they are read off directly.

Window hashes have 64 bits and are built by doubling. Many documents are searched at once, one after another with a
separator that occurs nowhere else, which no run can hold.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import WORD, take

# A run has at least this many words.
SHORTEST = 12
# Words searched at once; a longer document is searched alone. Memory is about 8 bytes x words x log2(longest document).
SLICE_WORDS = 300_000
UINT = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: shifts and odd multipliers."""
    x = (x ^ (x >> UINT(30))) * UINT(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> UINT(27))) * UINT(0x94D049BB133111EB)
    return x ^ (x >> UINT(31))


def _ahead(x: np.ndarray, by: int, fill: int = 0) -> np.ndarray:
    out = np.full_like(x, fill)
    if by < len(x):
        out[: len(x) - by] = x[by:]
    return out


class Words:
    """Word numbers of one or more documents, a separator before and after each, and the hashes of their windows."""

    def __init__(self, documents: Sequence[np.ndarray]) -> None:
        kinds = 1 + max((int(d.max()) for d in documents if len(d)), default=0)
        parts = [np.array([kinds])]
        self.starts, at = [], 1
        for i, d in enumerate(documents):
            self.starts.append(at)
            parts += [d, np.array([kinds + 1 + i])]
            at += len(d) + 1
        self.ids = np.concatenate(parts).astype(np.int64)
        self.longest = max((len(d) for d in documents), default=0)
        # windows[k][i] stands for the 2^k words from i; windows over the end hold the last separator.
        self.windows = [_mix(self.ids.astype(UINT) + UINT(0x9E3779B97F4A7C15))]
        while 2 ** len(self.windows) <= self.longest:
            half = self.windows[-1]
            self.windows.append(_mix(half * UINT(0x9E3779B97F4A7C15) + _ahead(half, 2 ** (len(self.windows) - 1))))

    def forward(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """How many words from x (less than y) equal those from y."""
        out, n = np.zeros(len(x), dtype=np.int64), len(self.ids)
        # The first power is tried again until it fails, the smaller ones once.
        for k in range(len(self.windows) - 1, -1, -1):
            open_ = np.arange(len(x))
            while len(open_):
                b = y[open_] + out[open_]
                open_ = open_[b < n]
                a, b = x[open_] + out[open_], y[open_] + out[open_]
                open_ = open_[self.windows[k][a] == self.windows[k][b]]
                out[open_] += 2**k
                if k < len(self.windows) - 1:
                    break
        return out

    def backward(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """How many words before x (less than y) equal those before y."""
        out = np.zeros(len(x), dtype=np.int64)
        for k in range(len(self.windows) - 1, -1, -1):
            open_ = np.arange(len(x))
            while len(open_):
                open_ = open_[x[open_] - out[open_] >= 2**k]
                a, b = x[open_] - out[open_] - 2**k, y[open_] - out[open_] - 2**k
                open_ = open_[self.windows[k][a] == self.windows[k][b]]
                out[open_] += 2**k
                if k < len(self.windows) - 1:
                    break
        return out


def small_periods(ids: np.ndarray) -> list[np.ndarray]:
    """Runs (start, length, period) of periods 1 and 2: stretches of words equal to the next, or the next but one."""
    found = []
    for p in (1, 2):
        same = np.concatenate([[False], ids[:-p] == ids[p:], [False]]) if len(ids) > p else np.zeros(2, dtype=bool)
        edges = np.flatnonzero(same[1:] != same[:-1])
        start, end = edges[::2], edges[1::2]
        keep = (end - start >= p) & ((p == 1) | (ids[start] != ids[np.minimum(start + 1, len(ids) - 1)]))
        start, length = start[keep], (end - start + p)[keep]
        found.append(np.stack([start, length, np.full(len(start), p)], axis=1))
    return found


def synchronising(words: Words, k: int, regions: np.ndarray) -> np.ndarray:
    """Positions of the synchronising set of scale 2^k; ``regions`` are runs of smaller periods."""
    t, n = 2**k, len(words.ids)
    keys = words.windows[k].copy()
    barred = UINT(2**64 - 1)
    deep = regions[(regions[:, 2] * 3 <= t) & (regions[:, 1] >= t)]
    if len(deep):
        edge = np.bincount(deep[:, 0], minlength=n + 1) - np.bincount(deep[:, 0] + deep[:, 1] - t + 1, minlength=n + 1)
        keys[np.cumsum(edge[:n]) > 0] = barred
    least, width = keys, 1
    while width < t:
        least = np.minimum(least, _ahead(least, width, 2**64 - 1))
        width *= 2
    least = np.minimum(least, _ahead(least, 1, 2**64 - 1))
    return np.flatnonzero((least != barred) & ((keys == least) | (_ahead(keys, t, 2**64 - 1) == least)))


def _proposed(words: Words, k: int, at: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of synchronising positions of equal context whose distance the scale looks for."""
    t = 2**k
    whole = words.windows[k + 1]
    member = np.zeros(len(words.ids), dtype=bool)
    member[at] = True
    context = whole[at]
    order = np.argsort(context, kind="stable")
    at, context = at[order], context[order]
    lag, first = 1, np.arange(len(at))
    while True:
        first = first[first + lag < len(at)]
        # Farther partners of a position are farther away, so one that is out of reach has no more.
        first = first[(context[first] == context[first + lag]) & (at[first + lag] - at[first] < 6 * t)]
        if not len(first):
            return
        far = first[at[first + lag] - at[first] >= 3 * t]
        x, y = at[far], at[far + lag]
        # Where the positions just before are such a pair too, they propose the same run.
        fresh = ~(member[x - 1] & member[y - 1] & (whole[x - 1] == whole[y - 1]))
        if fresh.any():
            yield x[fresh], y[fresh]
        lag += 1


def _with_smaller_period(words: Words, start: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Whether a run's period repeats a proper divisor of it: then the whole run does."""
    out = np.zeros(len(start), dtype=bool)
    for i, q in enumerate(period.tolist()):
        rest, p = q, 2
        primes = set()
        while p * p <= rest:
            while rest % p == 0:
                primes.add(p)
                rest //= p
            p += 1
        if rest > 1:
            primes.add(rest)
        for p in primes:
            d = q // p
            if np.array_equal(words.ids[start[i] : start[i] + q - d], words.ids[start[i] + d : start[i] + q]):
                out[i] = True
                break
    return out


def all_runs(words: Words) -> np.ndarray:
    """Every run (start, length, period) with smallest period q and at least 2q words, once."""
    found = small_periods(words.ids)
    k = 0
    # A run of period 3t or more is at least 6t long.
    while 6 * 2**k <= words.longest:
        at = synchronising(words, k, np.concatenate(found))
        scale = [np.empty((0, 3), dtype=np.int64)]
        for x, y in _proposed(words, k, at):
            back, ahead = words.backward(x, y), words.forward(x, y)
            period = y - x
            start, length = x - back, back + ahead + period
            scale.append(np.stack([start, length, period], axis=1)[length >= 2 * period])
        runs = np.unique(np.concatenate(scale), axis=0)
        found.append(runs[~_with_smaller_period(words, runs[:, 0], runs[:, 2])])
        k += 1
    return np.concatenate(found)


def runs_of(documents: Sequence[np.ndarray], shortest: int = SHORTEST) -> list[np.ndarray]:
    """Per document its runs of ``shortest`` words or more, by start and then period, positions from 0."""
    words = Words(documents)
    runs = all_runs(words)
    runs = runs[runs[:, 1] >= shortest]
    runs = runs[np.lexsort((runs[:, 2], runs[:, 0]))]
    owner = np.searchsorted(words.starts, runs[:, 0], side="right") - 1
    cuts = np.searchsorted(owner, np.arange(len(documents) + 1))
    return [runs[a:b] - [s, 0, 0] for a, b, s in zip(cuts, cuts[1:], words.starts, strict=False)]


def repeated(runs: np.ndarray, n: int) -> np.ndarray:
    """Which of n words lie in a run after its first period."""
    edge = np.bincount(runs[:, 0] + runs[:, 2], minlength=n + 1) - np.bincount(runs[:, 0] + runs[:, 1], minlength=n + 1)
    return np.cumsum(edge[:n]) > 0


def _slices(lengths: Sequence[int], most: int) -> Iterator[list[int]]:
    """Documents by length, so that those searched at once need the same scales."""
    held, total = [], 0
    for i in sorted(range(len(lengths)), key=lengths.__getitem__):
        if held and total + lengths[i] > most:
            yield held
            held, total = [], 0
        held.append(i)
        total += lengths[i]
    if held:
        yield held


def find_runs(docs: DataFrame, columns: Sequence[str] = ("doc_id", "text"), shortest: int = SHORTEST, slice_words: int = SLICE_WORDS) -> DataFrame:
    """Per row: doc_id, n_words, runs (array of start, length, period), collapsed (the words outside repeats, joined by a space).

    Words are what ASCII white space separates, letters as they are. NULL, empty and blank texts have no words, no runs
    and an empty ``collapsed``. A NULL doc_id is kept; repeated rows each get their row; an empty table gives no rows.
    Further columns are ignored. Every document is searched whole and alone, whatever lies beside it.
    """
    picked = take(docs, *columns).toDF("doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    pattern = re.compile(WORD)
    run_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [pattern.findall(t or "") for t in batch["text"].to_pylist()]
            runs: list = [None] * len(texts)
            collapsed: list = [None] * len(texts)
            for part in _slices([len(t) for t in texts], slice_words):
                number: dict[str, int] = {}
                ids = [np.array([number.setdefault(w, len(number)) for w in texts[i]], dtype=np.int64) for i in part]
                for i, found in zip(part, runs_of(ids, shortest), strict=True):
                    runs[i] = [{"start": s, "length": n, "period": q} for s, n, q in found.tolist()]
                    kept = texts[i] if not len(found) else [w for w, gone in zip(texts[i], repeated(found, len(texts[i])).tolist(), strict=True) if not gone]
                    collapsed[i] = " ".join(kept)
            arrays = [batch["doc_id"], pa.array([len(t) for t in texts], pa.int64()), pa.array(runs, run_type), pa.array(collapsed, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_words", "runs", "collapsed"])

    return picked.mapInArrow(run, "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")


def with_planted_runs(docs: DataFrame, columns: Sequence[str] = ("doc_id", "text")) -> DataFrame:
    """doc_id and text, where one document in ten, by the hash of its id, repeats a stretch of its words to its end.

    With h = crc32(doc_id as text), g = h div 10 and n words: if h mod 10 = 0, word i from a = g mod n on becomes word
    a + (i - a) mod p with p = 1 + (n - a) div (3 + g mod 8). A NULL doc_id counts as the empty text. Texts without words stay.
    """
    rows = take(docs, *columns).toDF("doc_id", "text")
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    words = F.regexp_extract_all("text", F.lit(WORD.replace("\\x20", " ")), F.lit(0))
    # Columns of their own, so that a text is cut into words once.
    rows = rows.withColumn("_g", F.floor(h / 10)).withColumn("_words", F.when(h % 10 == 0, words))
    n, g = F.size("_words"), F.col("_g")
    rows = rows.withColumn("_a", F.when(n > 0, g % n).cast("int"))
    left = n - F.col("_a")
    rows = rows.withColumn("_left", left).withColumn("_p", (1 + F.floor(left / (3 + g % 8))).cast("int"))
    cycle = F.array_repeat(F.slice("_words", F.col("_a") + 1, F.col("_p")), F.ceil(F.col("_left") / F.col("_p")).cast("int"))
    tail = F.slice(F.flatten(cycle), F.lit(1), F.col("_left"))
    planted = F.array_join(F.concat(F.slice("_words", F.lit(1), F.col("_a")), tail), " ")
    return rows.select("doc_id", F.coalesce(planted, "text").alias("text"))
