"""Gradient-boosted trees of logistic loss over counts of binned rows.

A tree needs only sums of slopes per node, feature and bin. They are whole numbers, so that it does not matter where and in
which order rows are added: ``Held`` sums arrays at hand, ``Spread`` a DataFrame's partitions, with the same trees.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Bins of a feature, and the unit in which slopes are rounded: sums are exact in doubles up to 2^29 rows.
BINS, UNIT = 32, 2.0**24
NO_CUT = 255


@dataclass
class Trees:
    """Complete trees of one depth: per tree and inner node a feature, a cut and its bin, per leaf a value."""

    base: float
    depth: int
    feature: np.ndarray
    cut: np.ndarray
    bin: np.ndarray
    leaf: np.ndarray

    def probability(self, x: np.ndarray, binned: bool = False) -> np.ndarray:
        score = np.full(len(x), self.base)
        for t in range(len(self.leaf)):
            score += self.leaf[t, self.node(x, t, self.depth, binned)]
        return 1 / (1 + np.exp(-score))

    def node(self, x: np.ndarray, t: int, level: int, binned: bool) -> np.ndarray:
        """Where rows are in tree ``t`` at a level, counted from that level's first node."""
        rows, at = np.arange(len(x)), np.zeros(len(x), dtype=np.int64)
        cut = self.bin if binned else self.cut
        for _ in range(level):
            at = 2 * at + 1 + (x[rows, self.feature[t, at]] > cut[t, at])
        return at - (2**level - 1)


def binned(x: np.ndarray, cuts: Sequence[np.ndarray]) -> np.ndarray:
    """Per row and feature the number of cuts below the value."""
    return np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], axis=1).astype(np.uint8)


def _sums(bins: np.ndarray, yes: np.ndarray, no: np.ndarray, p: np.ndarray, node: np.ndarray, nodes: int) -> np.ndarray:
    """2 x nodes x features x bins: sums of slopes and of their changes, in units."""
    slope, bend = np.rint((yes - (yes + no) * p) * UNIT), np.rint((yes + no) * p * (1 - p) * UNIT)
    out = np.empty((2, nodes, bins.shape[1], BINS))
    for f in range(bins.shape[1]):
        slot = node * BINS + bins[:, f]
        for i, weight in enumerate((slope, bend)):
            out[i, :, f] = np.bincount(slot, weight, nodes * BINS).reshape(nodes, BINS)
    return out


class Held:
    """Counted rows at hand: bins, how many are true, how many are not."""

    def __init__(self, bins: np.ndarray, yes: np.ndarray, no: np.ndarray) -> None:
        self.rows, self.score = (bins, yes, no), None

    def __call__(self, trees: Trees, t: int, level: int) -> np.ndarray:
        bins = self.rows[0]
        if self.score is None:
            self.score = np.full(len(bins), trees.base)
        if not level and t:
            self.score += trees.leaf[t - 1, trees.node(bins, t - 1, trees.depth, True)]
        return _sums(*self.rows, 1 / (1 + np.exp(-self.score)), trees.node(bins, t, level, True), 2**level)


def unpacked(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The columns bins (bytes), yes and no of a batch."""
    bins = np.frombuffer(b"".join(batch["bins"].to_pylist()), dtype=np.uint8)
    return bins.reshape(len(batch), -1), batch["yes"].to_numpy(), batch["no"].to_numpy()


class Spread:
    """Counted rows of any number as a DataFrame with columns bins, yes and no; sums of few thousand cells come back."""

    def __init__(self, rows: DataFrame, width: int) -> None:
        self.rows, self.width = rows.select("bins", "yes", "no"), width

    def __call__(self, trees: Trees, t: int, level: int) -> np.ndarray:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = 0
            for batch in batches:
                bins, yes, no = unpacked(batch)
                grown = Trees(trees.base, trees.depth, trees.feature, trees.cut, trees.bin, trees.leaf[:t])
                total += _sums(bins, yes, no, grown.probability(bins, True), trees.node(bins, t, level, True), 2**level)
            if not isinstance(total, int):
                cells = total.reshape(2, -1).astype(np.int64)
                yield pa.RecordBatch.from_pydict({"cell": np.arange(cells.shape[1]), "slope": cells[0], "bend": cells[1]})

        cells = self.rows.mapInArrow(run, "cell long, slope long, bend long")
        found = cells.groupBy("cell").agg(F.sum("slope").alias("slope"), F.sum("bend").alias("bend")).toArrow()
        out = np.zeros((2, 2**level * self.width * BINS))
        for i, name in enumerate(("slope", "bend")):
            out[i, found["cell"].to_numpy()] = found[name].to_numpy()
        return out.reshape(2, 2**level, self.width, BINS)


def fit(sums: Held | Spread, cuts: Sequence[np.ndarray], share: float, rounds: int = 60, depth: int = 3, rate: float = 0.2, ridge: float = 1.0) -> Trees:
    """Second-order boosting; splits are chosen from the cuts of each feature, fewer than ``BINS``; ``share`` of the rows is true."""
    share = min(max(share, 1e-3), 1 - 1e-3)
    inner = (rounds, 2**depth - 1)
    out = Trees(float(np.log(share / (1 - share))), depth, np.zeros(inner, dtype=np.int64), np.full(inner, np.inf),
                np.full(inner, NO_CUT), np.zeros((rounds, 2**depth)))
    for t in range(rounds):
        for level in range(depth):
            first, count = 2**level - 1, 2**level
            g, h = np.cumsum(sums(out, t, level), axis=3) / UNIT
            # Unsplit nodes send all rows to the left.
            whole = np.stack([g[:, 0, -1], h[:, 0, -1]], axis=1)
            left = whole.copy()
            best = np.full(count, 1e-9)
            for f, c in enumerate(cuts):
                if not len(c):
                    continue
                a, b = g[:, f, : len(c)], h[:, f, : len(c)]
                gain = a**2 / (b + ridge) + (whole[:, :1] - a) ** 2 / (whole[:, 1:] - b + ridge) - whole[:, :1] ** 2 / (whole[:, 1:] + ridge)
                at = gain.argmax(axis=1)
                top = gain[np.arange(count), at]
                for k in np.flatnonzero(top > best):
                    best[k] = top[k]
                    out.feature[t, first + k], out.cut[t, first + k], out.bin[t, first + k] = f, c[at[k]], at[k]
                    left[k] = a[k, at[k]], b[k, at[k]]
        leaves = np.stack([left, whole - left], axis=1).reshape(-1, 2)
        out.leaf[t] = rate * leaves[:, 0] / (leaves[:, 1] + ridge)
    return out
