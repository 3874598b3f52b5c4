"""Quality by nearest-neighbour voting in a latent semantic space.

Terms describe form, not topic: runs of character classes in threes, and how often words repeat. Their
document frequencies are counted over all documents. A bounded sample of labelled documents gives the
term matrix whose leading singular vectors span the latent space; its documents' vectors are broadcast.
Every document is projected, its cosines to all of them are computed in exact blocked products, and the
nearest vote for their label, weighted by similarity.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import crc_remainder, slices, take

SAMPLE, DIMENSIONS, NEIGHBOURS, SHARPNESS = 4096, 48, 25, 8
THRESHOLD = 0.3
# Character classes: letters, digits, white space, bytes beyond ASCII, and punctuation by habit of use.
LOWER_, UPPER_, DIGIT, SPACE, LINE, BEYOND, STOP, COMMA, SHOUT, MONEY, HASH, STAR, AND, BAR, QUOTE, OTHER = range(16)
CLASSES = 16
REPEATS, VARIETY, LENGTHS = (0.01, 0.03, 0.06, 0.12, 0.25, 0.5), (0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9), (2, 3, 4, 5, 6, 8, 12)
SHAPES = CLASSES**3
TERMS = SHAPES + len(REPEATS) + len(VARIETY) + len(LENGTHS) + 3
BINNED_WEIGHT = 3.0


def _classes() -> np.ndarray:
    table = np.full(256, OTHER, dtype=np.uint8)
    table[128:] = BEYOND
    for chars, kind in (("abcdefghijklmnopqrstuvwxyz", LOWER_), ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", UPPER_), ("0123456789", DIGIT),
                        (" \t", SPACE), ("\n\r\x0b\x0c", LINE), (".", STOP), (",", COMMA), ("!?", SHOUT), ("$", MONEY), ("#", HASH),
                        ("*", STAR), ("%&", AND), ("|", BAR), ("\"'()-:;", QUOTE)):
        table[[ord(c) for c in chars]] = kind
    return table


TABLE = _classes()


def terms(texts: Sequence[str]) -> np.ndarray:
    """Texts x TERMS: counts of class triples, and one bin each of repetition, variety and word length."""
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    kinds = TABLE[np.frombuffer(b"".join(raw), dtype=np.uint8)].astype(np.int64)
    doc = np.repeat(np.arange(len(raw)), [len(r) for r in raw])
    out = np.zeros((len(raw), TERMS), dtype=np.float32)
    if len(kinds):
        first = np.concatenate([[True], (kinds[1:] != kinds[:-1]) | (doc[1:] != doc[:-1])])
        kinds, doc = kinds[first], doc[first]
    if len(kinds) > 2:
        same = doc[2:] == doc[:-2]
        key = (doc[2:] * SHAPES + kinds[:-2] * CLASSES**2 + kinds[1:-1] * CLASSES + kinds[2:])[same]
        out[:, :SHAPES] = np.bincount(key, minlength=len(raw) * SHAPES).reshape(len(raw), SHAPES)
    at = SHAPES
    words = [t.split() for t in texts]
    n = np.array([len(w) for w in words])
    measures = (
        (np.array([sum(map(str.__eq__, w, w[1:])) for w in words]) / np.maximum(n - 1, 1), REPEATS),
        (np.array([len(set(w)) for w in words]) / np.maximum(n, 1) ** 0.85, VARIETY),
        (np.array([len(t) for t in texts]) / np.maximum(n, 1), LENGTHS),
    )
    some = np.flatnonzero(n > 0)
    for values, bins in measures:
        out[some, at + np.searchsorted(bins, values[some])] = BINNED_WEIGHT
        at += len(bins) + 1
    return out


@dataclass
class Voter:
    """weight: inverse document frequency per term; axes: terms x dimensions; rows: labelled vectors."""

    weight: np.ndarray
    axes: np.ndarray
    rows: np.ndarray
    labels: np.ndarray
    prior: float

    def vectors(self, found: np.ndarray) -> np.ndarray:
        return _unit(_weighted(found, self.weight) @ self.axes)

    def scores(self, texts: Sequence[str]) -> np.ndarray:
        x = self.vectors(terms(texts))
        out = np.full(len(texts), self.prior)
        k = min(NEIGHBOURS, len(self.rows))
        for at in range(0, len(x), 512):
            near = x[at : at + 512] @ self.rows.T
            top = np.argpartition(-near, k - 1, axis=1)[:, :k]
            vote = np.maximum(np.take_along_axis(near, top, axis=1).astype(np.float64), 0) ** SHARPNESS
            all_ = vote.sum(axis=1)
            score = (vote * self.labels[top]).sum(axis=1) / np.maximum(all_, 1e-12)
            out[at : at + 512] = np.where(all_ > 1e-9, np.clip(score, 0, 1), self.prior)
        return out


def _unit(x: np.ndarray) -> np.ndarray:
    length = np.sqrt((x**2).sum(axis=1, keepdims=True))
    return x / np.maximum(length, 1e-12)


def _weighted(found: np.ndarray, weight: np.ndarray) -> np.ndarray:
    return _unit(np.log1p(found) * weight)


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, rows = np.zeros(TERMS, dtype=np.int64), 0
    for batch in batches:
        for _, texts in slices(x.as_py() for x in batch["text"]):
            total += (terms(texts) > 0).sum(axis=0)
            rows += len(texts)
    some = np.flatnonzero(total)
    yield pa.RecordBatch.from_pydict({"term": pa.array(np.append(some, -1), pa.int32()), "n": np.append(total[some], rows)})


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, texts in slices(x.as_py() for x in batch["text"]):
            found = terms(texts)
            some = [np.flatnonzero(f) for f in found]
            yield pa.RecordBatch.from_pydict({
                "label": batch["label"].slice(first, len(texts)),
                "term": pa.array([s.astype(np.int32) for s in some], pa.list_(pa.int32())),
                "n": pa.array([f[s] for f, s in zip(found, some, strict=True)], pa.list_(pa.float32())),
            })


def _axes(matrix: np.ndarray, dimensions: int) -> np.ndarray:
    """Leading right singular vectors, by subspace iteration from a fixed start."""
    rng = np.random.default_rng(5)
    basis = np.linalg.qr(matrix.T @ rng.normal(size=(len(matrix), dimensions + 16)))[0]
    for _ in range(6):
        basis = np.linalg.qr(matrix.T @ (matrix @ basis))[0]
    _, _, rotation = np.linalg.svd(matrix @ basis, full_matrices=False)
    return (basis @ rotation.T)[:, :dimensions].astype(np.float32)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, dimensions: int = DIMENSIONS) -> Voter | None:
    """docs (doc_id, text) give document frequencies; docs in labels (doc_id, label) give votes.

    At most ``sample`` labelled documents vote, those with the smallest hashes of their id and text.
    """
    frequencies = docs.select("text").mapInArrow(_frequencies, "term int, n long").groupBy("term").agg(F.sum("n").alias("n"))
    counted = {r["term"]: r["n"] for r in frequencies.collect()}  # at most TERMS + 1 rows
    n = counted.pop(-1, 0)
    seen = np.zeros(TERMS)
    seen[list(counted)] = list(counted.values())
    weight = np.log((1 + n) / (1 + seen)).astype(np.float32) + 0.1

    # Labels of absent documents must not take places in the sample.
    present = labels.join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
    first = present.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    chosen = docs.join(F.broadcast(first), "doc_id").orderBy(F.xxhash64("doc_id"), F.xxhash64("text")).limit(sample)
    found = chosen.select("label", "text").mapInArrow(_sampled, "label double, term array<int>, n array<float>").toArrow()
    if not found.num_rows:
        return None
    matrix = np.zeros((found.num_rows, TERMS), dtype=np.float32)
    sizes = np.array([len(x) for x in found["term"].to_pylist()])
    flat = found["term"].combine_chunks().flatten().to_numpy()
    matrix[np.repeat(np.arange(len(sizes)), sizes), flat] = found["n"].combine_chunks().flatten().to_numpy()
    y = found["label"].to_numpy()
    matrix = _weighted(matrix, weight)
    axes = _axes(matrix, min(dimensions, *matrix.shape))
    return Voter(weight, axes, _unit(matrix @ axes), y, float(y.mean()))


def judge(
    docs: DataFrame, labels: DataFrame, modulus: int = 5, held: int = 0, threshold: float = THRESHOLD,
    columns: Sequence[str] = ("doc_id", "text"), label: str = "quality",
) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted.

    Learns from labelled documents whose crc32(doc_id) modulo ``modulus`` is not ``held``; rows of
    labels with a NULL id or label are ignored, several labels of a document are averaged. NULL and empty
    texts, which have no terms, get the share of label 1 in the sample as their score, and so does every
    text without similar neighbours; 0.5 if there are no labels. Repeated rows each get their row; an
    empty table gives none. Further columns are ignored.
    """
    picked = take(docs, *columns).toDF("doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    known = take(labels, "doc_id", label).toDF("doc_id", "label").dropna()
    known = known.filter(crc_remainder("doc_id", modulus) != held)
    known = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.avg("label").alias("label"))
    voter = fit(picked, known)
    held_out = (crc_remainder("doc_id", modulus) == held).alias("held_out")
    rows = picked.select("doc_id", held_out, "text")
    if voter is None:
        scored = rows.select("doc_id", "held_out", F.lit(0.5).alias("score"))
    else:
        shared = docs.sparkSession.sparkContext.broadcast(voter)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = [shared.value.scores(texts) for _, texts in slices(x.as_py() for x in batch["text"])]
                scores = np.concatenate(found) if found else np.empty(0)
                yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["held_out"], pa.array(scores, pa.float64())], ["doc_id", "held_out", "score"])

        scored = rows.mapInArrow(run, "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
