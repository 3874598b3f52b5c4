"""SimHash near-duplicates through tables of distances to reference fingerprints.

Distances of a fingerprint to reference fingerprints differ between two fingerprints by no more than
their own distance. The references come in five families: a family's references differ from the
origin in the bits of one block only, so its distances, taken relative to the origin's, depend on that
block alone. Fingerprints at most three bits apart leave two of the five families with equal
coordinates: pairs of families are the keys of the equi-join. Inside a key, pairs whose coordinates to
further, pseudo-random references differ by more than three are discarded, and the survivors' own
distance is counted.

Equal fingerprints are one class from the start. A key that holds many fingerprints is cut into chunks,
and chunks meet two at a time in tasks of bounded size. From a key only a spanning forest of its links
leaves the task, never all pairs; the components are the same.

Three bits reach only nearly equal texts. ``one_of_each`` therefore takes fingerprints as proposals: sampled bits are the keys
of many tables, all pairs of a key are compared by 256 bits, and the exact similarity of full shingle sets confirms.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import minhash
from tidemark.llm.common import numbered, stored, take, without, words
from tidemark.llm.components import components

SEED, SHINGLE, BITS, DISTANCE = 42, 3, 64, 3
FAMILIES = ((0, 13), (13, 26), (26, 39), (39, 52), (52, 64))
KEYS = tuple(combinations(range(len(FAMILIES)), len(FAMILIES) - DISTANCE))
CHUNK = 2048
# The pipeline's stage works on five-word shingles and 80 percent of similarity. Fingerprints of such pairs are some 10
# bits apart, and more than 20 with a chance of one in two thousand.
STAGE_SHINGLE, STAGE_SHARE, STAGE_DISTANCE = 5, 80, 20
# Words of 64 bits of a wide fingerprint and the bits that two may differ in: some 39 of 256 at 80 percent, 128 of unlike sets.
WIDE, WIDE_DISTANCE = 4, 64
# Pairs compared at a time, and rows of keys that leave Python at once: a few MB each.
PAIRS, KEY_ROWS = 65_536, 16_384
ORIGIN = np.uint64(0)


def references(n: int = 16) -> np.ndarray:
    """Pseudo-random reference fingerprints, the same in every task."""
    return np.array([xxhash.xxh64_intdigest(f"reference {i}", seed=SEED) for i in range(n)], dtype=np.uint64)


def distance_table(fingerprints: np.ndarray, refs: np.ndarray) -> np.ndarray:
    return np.bitwise_count(fingerprints[:, None] ^ refs[None, :]).astype(np.int8)


def family_coordinates(fingerprints: np.ndarray, family: int) -> np.ndarray:
    """A family's distances relative to the origin's (+1 or -1 each), packed into one number."""
    low, high = FAMILIES[family]
    refs = np.left_shift(np.uint64(1), np.arange(low, high, dtype=np.uint64))
    table = distance_table(fingerprints, refs) - distance_table(fingerprints, np.array([ORIGIN]))
    return ((table < 0) << np.arange(high - low, dtype=np.int64)).sum(axis=1)


def fingerprint_of(hashes: np.ndarray) -> int:
    """Bits set in more than half of the hashes."""
    if not len(hashes):
        return 0
    counts = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), 65_536):  # 4 MB of unpacked bits at a time
        part = hashes[at : at + 65_536].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<u8")[0])


def shingle_hashes(text: str | None) -> np.ndarray:
    w = words(text)
    if not w:
        return np.empty(0, dtype=np.uint64)
    digest, seed = xxhash.xxh64_intdigest, SEED
    if len(w) < SHINGLE:
        return np.array([digest(" ".join(w), seed)], dtype=np.uint64)
    return np.array([digest(f"{a} {b} {c}", seed) for a, b, c in zip(w, w[1:], w[2:], strict=False)], dtype=np.uint64)


def fingerprints(docs: DataFrame, columns: Sequence[str] = ("doc_id", "text")) -> DataFrame:
    """doc_id, text_hash and the fingerprint (as a signed long) of every row."""
    picked = take(docs, *columns).toDF("doc_id", "text")
    picked = picked.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint_of(shingle_hashes(x.as_py())) for x in batch["text"]]
            marks = pa.array(np.array(found, dtype=np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["text_hash"], marks], ["doc_id", "text_hash", "mark"])

    return picked.mapInArrow(run, "doc_id long, text_hash long, mark long")


def _keyed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        marks = batch["mark"].to_numpy().view(np.uint64)
        coordinates = [family_coordinates(marks, f) for f in range(len(FAMILIES))]
        for i, pair in enumerate(KEYS):
            key = np.full(len(marks), i, dtype=np.int64)
            for f in pair:
                key = (key << (FAMILIES[f][1] - FAMILIES[f][0])) | coordinates[f]
            yield pd.DataFrame({"key": key, "mark": batch["mark"].to_numpy()})


class Forest:
    """Union of rows of one batch by their links, smallest index first."""

    def __init__(self, n: int) -> None:
        self.root = np.arange(n)

    def tie(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            a, b = self.root[a], self.root[b]
            low, high = np.minimum(a, b), np.maximum(a, b)
            open_ = low < high
            if not open_.any():
                return
            a, b = low[open_], high[open_]
            np.minimum.at(self.root, b, a)
            while (self.root[self.root] != self.root).any():
                self.root = self.root[self.root]


def _forest(keys: np.ndarray, side: np.ndarray, marks: np.ndarray) -> pd.DataFrame:
    """A spanning forest of the links inside each run of equal keys; rows are sorted by key."""
    table = distance_table(marks, references())
    forest = Forest(len(marks))
    at = np.arange(len(marks))
    lag = 1
    while True:
        at = at[at + lag < len(marks)]
        at = at[keys[at] == keys[at + lag]]
        if not len(at):
            break
        a, b = at, at + lag
        # Two chunks of a large key: pairs inside a chunk are met elsewhere.
        fresh = (side[a] < 0) | (side[a] != side[b])
        a, b = a[fresh], b[fresh]
        for start in range(0, len(a), 262_144):
            x, y = a[start : start + 262_144], b[start : start + 262_144]
            near = np.abs(table[x] - table[y]).max(axis=1) <= DISTANCE
            x, y = x[near], y[near]
            close = np.bitwise_count(marks[x] ^ marks[y]) <= DISTANCE
            forest.tie(x[close], y[close])
        lag += 1
    tied = np.flatnonzero(forest.root != np.arange(len(marks)))
    return pd.DataFrame({"a": marks[tied].view(np.int64), "b": marks[forest.root[tied]].view(np.int64)})


def _whole_runs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Runs of equal (key, meeting) of a sorted partition; a run that a batch cuts waits for the next."""
    held = None
    for batch in batches:
        part = batch if held is None else pd.concat([held, batch], ignore_index=True)
        if not len(part):
            continue
        last = part.iloc[-1]
        cut = len(part) - int(((part["key"] == last["key"]) & (part["meeting"] == last["meeting"])).sum())
        held = part.iloc[cut:].reset_index(drop=True)
        if cut:
            yield part.iloc[:cut]
    if held is not None:
        yield held


def _run_numbers(part: pd.DataFrame) -> np.ndarray:
    return (part["key"].ne(part["key"].shift()) | part["meeting"].ne(part["meeting"].shift())).cumsum().to_numpy()


def _linked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for part in _whole_runs(batches):
        yield _forest(_run_numbers(part), part["side"].to_numpy(), part["mark"].to_numpy().view(np.uint64))


def links(marks: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Links (a, b) whose components are those of all pairs of distinct marks at most three bits apart."""
    keyed = stored(marks.mapInPandas(_keyed, "key long, mark long"), "simhash-keys")
    return dealt(keyed, "mark", chunk).mapInPandas(_linked, "a long, b long")


def dealt(keyed: DataFrame, member: str, chunk: int) -> DataFrame:
    """Rows dealt to tasks and sorted by (key, meeting, member); a large key's chunks meet two at a time, pairs of one chunk once."""
    sizes = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    # Written, so that Spark knows the size of this list and broadcasts it only if it is small.
    large = stored(sizes.filter(F.col("n") > 2 * chunk).select("key", F.ceil(F.col("n") / chunk).cast("int").alias("chunks")), "simhash-large")
    own = [c for c in keyed.columns if c != "key"]
    small = keyed.join(large, "key", "left_anti").select("key", F.lit(0).cast("long").alias("meeting"), F.lit(-1).alias("side"), *own)
    cut = keyed.join(large, "key").withColumn("side", F.pmod(F.xxhash64(member), F.col("chunks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))
    cut = cut.withColumn("_other", other)
    # A chunk's own pairs are compared in its meeting with itself.
    meeting = F.least("side", "_other").cast("long") * F.lit(1 << 20) + F.greatest("side", "_other") + 1
    side = F.when(F.col("side") == F.col("_other"), F.lit(-1)).otherwise(F.col("side"))
    cut = cut.select("key", meeting.alias("meeting"), side.alias("side"), *own)
    return small.union(cut).repartition("key", "meeting").sortWithinPartitions("key", "meeting", member)


def _named(docs: DataFrame, columns: Sequence[str], chunk: int) -> tuple[DataFrame, DataFrame]:
    """Rows with their marks, and per mark its component's root."""
    rows = stored(fingerprints(docs, columns), "simhash-marks")
    marks = rows.groupBy("mark").agg(F.min("doc_id").alias("first"))
    tied = components(links(marks.select("mark"), chunk))
    rooted = marks.join(tied, F.col("mark") == F.col("node"), "left")
    return rows, stored(rooted.select("mark", F.coalesce("root", "mark").alias("root"), "first"), "simhash-roots")


def near_duplicates(docs: DataFrame, columns: Sequence[str] = ("doc_id", "text"), chunk: int = CHUNK) -> DataFrame:
    """Per row: doc_id, fingerprint, component_id (smallest doc_id reachable over links).

    NULL, empty and blank texts have fingerprint zero and are linked like any other. Repeated rows each
    get their row. A NULL doc_id is kept and never names a component unless all of its component's ids
    are NULL. An empty table gives no rows. Further columns are ignored.
    """
    rows, rooted = _named(docs, columns, chunk)
    names = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = rooted.select("mark", "root").join(names, "root").select("mark", "component_id")
    return rows.join(named, "mark").select("doc_id", F.lower(F.lpad(F.hex("mark"), 16, "0")).alias("fingerprint"), "component_id")


def sampled_keys(marks: np.ndarray, tables: int, bits: int) -> np.ndarray:
    """Per fingerprint and table a key of ``bits`` of its bits, other ones in each table."""
    pick = np.random.default_rng(SEED)
    chosen = np.stack([pick.permutation(BITS)[:bits] for _ in range(tables)]).astype(np.uint64)
    keys = np.empty((len(marks), tables), dtype=np.int64)
    for t in range(tables):
        drawn = (marks[:, None] >> chosen[t][None, :]) & np.uint64(1)
        keys[:, t] = (drawn << np.arange(bits, dtype=np.uint64)).sum(axis=1).astype(np.int64) * tables + t
    return keys


def tables_for(rows: int, share: int, miss: float) -> tuple[int, int]:
    """How many tables of how many bits: some 256 rows a key, all of which are compared, and few misses among pairs at the threshold.

    Of two sets of equal size at Jaccard j the cosine is 2j/(1+j), and a bit differs with the angle's share of pi.
    """
    j = share / 100
    same = 1 - np.arccos(2 * j / (1 + j)) / np.pi
    bits = min(48, max(4, int(np.ceil(np.log2(max(rows, 1)))) - 8))
    return int(np.ceil(np.log(1 / miss) / same**bits)), bits


def wide_fingerprint(hashes: np.ndarray) -> list[int]:
    """The fingerprint of the hashes and of further hashes made from them."""
    return [fingerprint_of(hashes if not i else minhash._mix(hashes + np.uint64(i * minhash.GOLDEN % 2**64))) for i in range(WIDE)]


MARKS = [f"m{i}" for i in range(WIDE)]


def _sets_signed(docs: DataFrame, columns: Sequence[str], shingle: int) -> DataFrame:
    """Per row: doc_id, text_hash, n_shingles, set_id (128 bits of the set of shingles) and the wide fingerprint of that set."""
    picked = take(docs, *columns).toDF("doc_id", "text")
    picked = picked.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [minhash.shingle_set(x.as_py(), shingle) for x in batch["text"]]
            marks = np.array([wide_fingerprint(s) for s in sets], dtype=np.uint64).reshape(-1, WIDE).view(np.int64)
            names = pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary())
            sizes = pa.array([len(s) for s in sets], pa.int64())
            found = [batch["doc_id"], batch["text_hash"], sizes, names, *[pa.array(marks[:, i]) for i in range(WIDE)]]
            yield pa.RecordBatch.from_arrays(found, ["doc_id", "text_hash", "n_shingles", "set_id", *MARKS])

    return picked.mapInArrow(run, f"doc_id long, text_hash long, n_shingles long, set_id binary, {', '.join(f'{m} long' for m in MARKS)}")


def close_pairs(marks: np.ndarray, roots: np.ndarray, sides: np.ndarray, distance: int, hubs: bool) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (later, earlier) of rows of different roots that are close in one word's bits and in all; with ``hubs`` each row's first."""
    later, earlier = [], []
    step = max(1, PAIRS // max(len(marks), 1))
    for at in range(0, len(marks), step):
        end = min(at + step, len(marks))
        near = np.bitwise_count(marks[at:end, None, 0] ^ marks[None, :end, 0]) <= distance
        i, j = np.nonzero(near)
        i += at
        # Two chunks of a large key: pairs inside a chunk are met elsewhere.
        fresh = (j < i) & (roots[i] != roots[j]) & ((sides[i] < 0) | (sides[i] != sides[j]))
        i, j = i[fresh], j[fresh]
        close = np.bitwise_count(marks[i] ^ marks[j]).sum(axis=1, dtype=np.int64) <= WIDE_DISTANCE
        i, j = i[close], j[close]
        if hubs:
            i, first = np.unique(i, return_index=True)
            j = j[first]
        later.append(i)
        earlier.append(j)
    return np.concatenate([*later, np.empty(0, np.int64)]).astype(np.int64), np.concatenate([*earlier, np.empty(0, np.int64)]).astype(np.int64)


def _proposed(classes: DataFrame, tables: int, bits: int, used: int, distance: int, hubs: bool, chunk: int, share: int) -> DataFrame:
    """Pairs (a, b) of classes (node, root, n, marks) of different roots that are close and share a key of the first ``used`` tables."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            step = max(1, KEY_ROWS // used)
            for at in range(0, len(batch), step):
                part = batch.slice(at, step)
                found = sampled_keys(part["m0"].to_numpy().view(np.uint64), tables, bits)[:, :used]
                repeat = [np.repeat(part[c].to_numpy(), used) for c in ("node", "root", *MARKS)]
                yield pa.RecordBatch.from_arrays([pa.array(found.ravel()), *map(pa.array, repeat)], ["key", "node", "root", *MARKS])

    def compared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in _whole_runs(batches):
            marks = np.ascontiguousarray(part[MARKS].to_numpy()).view(np.uint64)
            node, root, side = (part[c].to_numpy() for c in ("node", "root", "side"))
            starts = np.flatnonzero(np.diff(_run_numbers(part), prepend=-1, append=-1))
            for low, high in zip(starts, starts[1:], strict=False):
                if high - low > 1:
                    i, j = close_pairs(marks[low:high], root[low:high], side[low:high], distance, hubs)
                    yield pd.DataFrame({"a": node[low:high][i], "b": node[low:high][j]})

    numbers = ", ".join(f"{c} long" for c in ("key", "node", "root", *MARKS))
    keyed = classes.select("node", "root", *MARKS).mapInArrow(keys, numbers)
    met = dealt(keyed, "node", chunk).mapInPandas(compared, "a long, b long")
    pairs = met.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    for side in ("a", "b"):
        pairs = pairs.join(classes.select(F.col("node").alias(side), F.col("n").alias(f"n{side}")), side)
    fits = F.least("na", "nb") * 100 >= F.greatest("na", "nb") * share
    return stored(pairs.filter(fits).select("a", "b"), "similar-pairs")


def similar(
    docs: DataFrame, columns: Sequence[str], shingle: int, share: int, miss: float, distance: int, first: int = 8, chunk: int = CHUNK
) -> tuple[DataFrame, DataFrame]:
    """Rows with their set's name, and per set its component under exact similarity of at least ``share`` percent.

    Fingerprints only propose: sets meet in tables keyed by some of their fingerprints' bits, pairs more than ``distance``
    bits apart or far apart in the wide fingerprint are dropped, and full sets confirm. In the ``first`` tables each set
    meets the smallest close set of its key, so that the many members of one group are tied by few comparisons. After
    that all pairs of every key that are close and not tied yet are confirmed: no partner is left out. Large keys are
    met in chunks, so that no task holds a whole one.
    """
    rows = stored(_sets_signed(docs, columns, shingle), "similar-rows")
    classes = minhash.numbered_classes(rows, *[F.first(m).alias(m) for m in MARKS])
    tables, bits = tables_for(classes.count(), share, miss)
    whole = classes.filter("n > 0")
    links = None
    tied = None
    for used, hubs in ((min(first, tables), True), (tables, False)):
        rooted = whole.withColumn("root", F.col("node")) if tied is None else whole.join(tied, "node", "left").withColumn("root", F.coalesce("root", "node"))
        pairs = _proposed(rooted, tables, bits, used, distance, hubs, chunk, share)
        nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        found = stored(minhash.confirmed(pairs, minhash.full_sets(docs, columns, classes, nodes, shingle), share), "similar-links")
        links = found if links is None else links.union(found)
        tied = stored(components(links), "similar-components")
    rooted = classes.select("set_id", "node").join(tied, "node", "left")
    return rows, stored(rooted.select("set_id", F.coalesce("root", "node").alias("root")), "similar-roots")


def one_of_each(
    docs: DataFrame, shingle: int = STAGE_SHINGLE, share: int = STAGE_SHARE, miss: float = 0.03, distance: int = STAGE_DISTANCE
) -> DataFrame:
    """The documents, all columns, one of each component of sets at least ``share`` percent similar.

    ``miss`` is the share of pairs right at the threshold that no table may propose; more similar ones are missed far more
    rarely. The smallest doc_id stays (NULL last), then the smallest text hash; of rows equal in both, copies of one
    document, one stays. Texts without words are one component. An empty table gives no rows. Further columns stay,
    whatever their names.
    """
    rows, rooted = similar(docs, ("doc_id", "text"), shingle, share, miss, distance)
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    per_set = rows.groupBy("set_id").agg(F.min(rank).alias("least"))
    best = rooted.join(per_set, "set_id")
    best = best.join(best.groupBy("root").agg(F.min("least").alias("stays")), "root").select("set_id", "stays")
    placed = rows.join(stored(best, "similar-best"), "set_id")
    left = without(docs, placed.filter(rank != F.col("stays")), "simhash-copies")
    copies = rows.groupBy("doc_id", "text_hash").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    copies = stored(copies.select(F.col("doc_id").alias("copy_id"), F.col("text_hash").alias("copy_hash")), "simhash-repeats")
    if copies.isEmpty():
        return left
    wide, of = numbered(left)
    keyed = wide.withColumns({"row_doc": F.col(of("doc_id")).cast("long"), "row_text": F.xxhash64(of("text"))})
    same = F.col("row_doc").eqNullSafe(F.col("copy_id")) & (F.col("row_text") == F.col("copy_hash"))
    single = keyed.join(copies, same, "left_anti")
    repeated = keyed.join(copies, same, "left_semi").dropDuplicates(["row_doc", "row_text"])
    return single.union(repeated).drop("row_doc", "row_text").toDF(*docs.columns)
