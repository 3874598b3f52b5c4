"""MinHash near-duplicates by SuperMinHash signatures, bands, exact confirmation and components.

A signature has one place per hash function. Every shingle walks a pseudo-random permutation of the places: at step j it
offers the j-th place the rank j plus a random fraction, and each place keeps its smallest rank. Ranks of one shingle at
different places thus exclude each other, which lowers the variance against independent hashes. A document whose places all
hold ranks below j can't change any more at step j: it stops there, after one to three steps unless it is short.

Equal sets of shingles are one class. Bands of a class's signature are keys; classes that share a key are candidates.

* First every class meets the smallest class of each of its keys: pairs grow with the classes, not with their squares. The
  Jaccard similarity of full sets confirms a link. Most classes that share a key are far less similar; a sketch, one byte of
  each place, tells these apart before any full set is moved, and misses one pair in 100 million right at the threshold.
* Keys of three or more classes that lie in several components after that may hold further links. Their members are dealt
  to meetings of bounded size, and only classes of different components are compared there, those that share one of their
  rarest shingles (a prefix that any pair at the threshold shares). A meeting sends a spanning forest of its links on.
  Sketches meet first: members without a partner of another component stay away, and where a meeting has few pairs of
  partners, these are confirmed as pairs, each once however many keys it shares.

Sets are compared by 64-bit hashes of their shingles; classes are told apart by 128 bits of the sorted hashes.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import sized, slices, stored, take, words
from tidemark.llm.components import components

# Shingle words and percent of similarity of the task. Of pairs at 85 %, 24 bands of five miss one in a million.
SHINGLE, SHARE, ROWS, BANDS = 3, 85, 5, 24
# Shingles of a chunk: two chunks meet in a task at a time.
CHUNK = 1_000_000
# Sketches of a chunk, and the chance that those of a pair right at the threshold agree too seldom.
SKETCHES, MISS = 4096, 1e-8
GOLDEN = 0x9E3779B97F4A7C15
NONE = np.uint64(2**64 - 1)


def shingle_set(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """Sorted hashes of a text's distinct shingles; the whole sequence if it has fewer words, nothing without words."""
    w = words(text)
    if not w:
        return np.empty(0, dtype=np.uint64)
    distinct = {" ".join(w)} if len(w) < shingle else set(map(" ".join, zip(*[w[i:] for i in range(shingle)], strict=False)))
    digest = xxhash.xxh64_intdigest
    return np.sort(np.fromiter((digest(s) for s in distinct), dtype=np.uint64, count=len(distinct)))


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: shifts and odd multipliers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def superminhash(sets: Sequence[np.ndarray], places: int) -> np.ndarray:
    """Signatures (one row a set) of ranks: the step in the upper 32 bits, the fraction in the lower; empty sets keep the largest."""
    values = np.concatenate([*sets, np.empty(0, dtype=np.uint64)])
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    ranks = np.full(len(sets) * places, NONE)
    chosen: list[np.ndarray] = []
    for step in range(places):
        # Early stop: a document all of whose ranks are of earlier steps is done.
        unfinished = ranks.reshape(-1, places).max(axis=1) >= np.uint64(step << 32)
        going = unfinished[owner]
        if not going.all():
            values, owner, chosen = values[going], owner[going], [c[going] for c in chosen]
        if not len(values):
            break
        random = _mix(values + np.uint64((step + 1) * GOLDEN % 2**64))
        place = step + ((random & np.uint64(2**32 - 1)) * np.uint64(places - step) >> np.uint64(32)).astype(np.int32)
        chosen.append(place)
        # What earlier exchanges of the permutation left at the chosen place.
        for j in range(step - 1, -1, -1):
            place = np.where(chosen[j] == place, j, place)
        np.minimum.at(ranks, owner * places + place, np.uint64(step << 32) | (random >> np.uint64(32)))
    return ranks.reshape(-1, places)


def band_keys(signatures: np.ndarray, rows: int) -> np.ndarray:
    """A hash per band of ``rows`` places."""
    n, places = signatures.shape
    banded = signatures.reshape(n, places // rows, rows)
    keys = np.broadcast_to(_mix(np.arange(1, places // rows + 1, dtype=np.uint64) * np.uint64(GOLDEN)), banded.shape[:2])
    for i in range(rows):
        keys = _mix(keys * np.uint64(GOLDEN) + banded[:, :, i])
    return keys.view(np.int64)


def sketches(signatures: np.ndarray) -> np.ndarray:
    """The last byte of each place's rank."""
    return (signatures & np.uint64(255)).astype(np.uint8)


def least_agreeing(places: int, share: int, miss: float = MISS) -> int:
    """The most places of which a pair at ``share`` percent agrees in fewer with a chance of at most ``miss``.

    Places are counted as independent, which they are with a larger spread than SuperMinHash's.
    """
    j, fewer = share / 100, 0.0
    for k in range(places + 1):
        fewer += comb(places, k) * j**k * (1 - j) ** (places - k)
        if fewer > miss:
            return k
    return places


def signed(docs: DataFrame, columns: Sequence[str], shingle: int, rows: int, bands: int) -> DataFrame:
    """Per row: doc_id, text_hash, n_shingles, set_id (128 bits), its band keys (none for an empty set) and its sketch."""
    picked = take(docs, *columns).toDF("doc_id", "text")
    picked = picked.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in slices(batch["text"].to_pylist()):
                sets = [shingle_set(t, shingle) for t in texts]
                signatures = superminhash(sets, rows * bands)
                keys = band_keys(signatures, rows)
                here = batch.slice(at, len(texts))
                yield pa.RecordBatch.from_arrays(
                    [
                        here["doc_id"], here["text_hash"], pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                        pa.array([k if len(s) else None for k, s in zip(keys, sets, strict=True)], pa.list_(pa.int64())),
                        pa.array([x.tobytes() for x in sketches(signatures)], pa.binary()),
                    ],
                    ["doc_id", "text_hash", "n_shingles", "set_id", "bands", "sketch"],
                )

    return picked.mapInArrow(run, "doc_id long, text_hash long, n_shingles long, set_id binary, bands array<long>, sketch binary")


def numbered_classes(rows: DataFrame, *more: Column) -> DataFrame:
    """One row per set of shingles: a number (node), its size, smallest doc_id, a row that has it, and further aggregates."""
    one = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    classes = rows.groupBy("set_id").agg(F.first("n_shingles").alias("n"), *more, F.min("doc_id").alias("first"), F.min(one).alias("one"))
    # Numbers only have to differ, and the written table fixes them.
    return stored(classes.withColumn("node", F.monotonically_increasing_id()), "minhash-classes")


def full_sets(docs: DataFrame, columns: Sequence[str], classes: DataFrame, nodes: DataFrame, shingle: int) -> DataFrame:
    """node and its set's sorted hashes as bytes, for the given nodes, from one row that has the set."""
    one = classes.join(nodes, "node", "left_semi").select("node", F.col("one.doc_id").alias("_doc"), F.col("one.text_hash").alias("_hash"))
    one = sized(stored(one, "minhash-rows"))
    texts = take(docs, *columns).toDF("doc_id", "text").withColumn("text_hash", F.xxhash64("text"))
    found = texts.join(one, F.col("doc_id").cast("long").eqNullSafe(F.col("_doc")) & (F.col("text_hash") == F.col("_hash")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # A repeated row has the same node.
            batch = batch.take(np.unique(batch["node"].to_numpy(), return_index=True)[1])
            hashes = pa.array([shingle_set(t, shingle).tobytes() for t in batch["text"].to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([batch["node"], hashes], ["node", "hashes"])

    sets = stored(found.select("node", "text").mapInArrow(run, "node long, hashes binary"), "minhash-sets")
    # Only rows repeated in several batches give a set twice.
    return stored(sets.dropDuplicates(["node"]), "minhash-sets") if sets.count() > sets.agg(F.count_distinct("node")).first()[0] else sets


def _hashes(data: bytes) -> np.ndarray:
    return np.frombuffer(data, dtype=np.uint64)


def _linked(a: int, b: int, common: int, share: int) -> bool:
    """Whether sets of these sizes with so many common shingles are similar enough; integers only."""
    return 100 * common >= share * (a + b - common)


def confirmed(pairs: DataFrame, sets: DataFrame, share: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held, ok = (None, None), []
            for x, node, y in zip(batch["x"], batch["b"].to_pylist(), batch["y"], strict=True):
                if held[0] != node:
                    held = (node, _hashes(y.as_py()))
                mine, theirs = _hashes(x.as_py()), held[1]
                at = np.minimum(np.searchsorted(theirs, mine), len(theirs) - 1)
                ok.append(_linked(len(mine), len(theirs), int((theirs[at] == mine).sum()), share))
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    left = pairs.join(sets.select(F.col("node").alias("a"), F.col("hashes").alias("x")), "a")
    both = left.join(sets.select(F.col("node").alias("b"), F.col("hashes").alias("y")), "b")
    return both.select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def _sketched(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return np.frombuffer(b"".join(batch[name].to_pylist()), dtype=np.uint8).reshape(len(batch), -1)


def likely(pairs: DataFrame, some: DataFrame, share: int, least: int) -> DataFrame:
    """The pairs whose sizes fit and whose sketches agree in at least so many places; ``some`` has n and sketch of each node."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            agree = (_sketched(batch, "x") == _sketched(batch, "y")).sum(axis=1) if len(batch) else np.empty(0)
            yield batch.select(["a", "b"]).filter(pa.array(agree >= least, pa.bool_()))

    left = pairs.join(some.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("x")), "a")
    both = left.join(some.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("y")), "b")
    near = F.least("na", "nb") * 100 >= F.greatest("na", "nb") * share
    return both.filter(near).select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def _partnered(open_: DataFrame, some: DataFrame, share: int, least: int, chunk: int) -> tuple[DataFrame, DataFrame]:
    """Pairs (a, b) of open members of different components that share a key and are alike by sketch and size, each once.

    A meeting with more such pairs than twice its members gives none: its members that have a partner come second (key,
    node, n, root, and weight of those in the key), to be met as a whole.
    """

    def partners(batch: pa.RecordBatch) -> pa.RecordBatch:
        sketch, n, root, side = _sketched(batch, "sketch"), *(batch[c].to_numpy() for c in ("n", "root", "side"))
        node, key = batch["node"].to_numpy(), batch["key"].to_numpy()
        found, pairs, few = np.zeros(len(n), dtype=bool), [], True
        columns = np.ascontiguousarray(sketch.T)
        for at in range(0, len(n), 256):
            own = slice(at, min(at + 256, len(n)))
            agree = np.zeros((own.stop - at, len(n)), dtype=np.uint16)
            for place in columns:
                agree += place[own, None] == place[None, :]
            sizes = 100 * np.minimum(n[own, None], n[None, :]) >= share * np.maximum(n[own, None], n[None, :])
            # Two chunks of a large key: pairs inside a chunk are met elsewhere.
            fresh = (side[own, None] < 0) | (side[own, None] != side[None, :])
            alike = (agree >= least) & sizes & fresh & (root[own, None] != root[None, :])
            found[own] = alike.any(axis=1)
            if few:
                i, j = np.nonzero(alike)
                once = j < i + at
                pairs.append(np.stack([node[i[once] + at], node[j[once]]]))
                few = sum(x.shape[1] for x in pairs) <= 2 * len(n)
        if few:
            a, b = np.concatenate(pairs, axis=1)
            return pa.RecordBatch.from_pydict({"key": pa.nulls(len(a), pa.int64()), "a": np.maximum(a, b), "b": np.minimum(a, b)})
        return pa.RecordBatch.from_pydict({"key": key[found], "a": node[found], "b": pa.nulls(int(found.sum()), pa.int64())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by (key, meeting); one meeting is held at a time."""
        held, place = [], None
        for batch in batches:
            key, meeting = batch["key"].to_numpy(), batch["meeting"].to_numpy()
            starts = np.flatnonzero((np.diff(key, prepend=key[:1]) != 0) | (np.diff(meeting, prepend=meeting[:1]) != 0))
            for low, high in zip([0, *starts], [*starts, len(key)], strict=True):
                if low == high:
                    continue
                if held and (key[low], meeting[low]) != place:
                    yield partners(pa.Table.from_batches(held).combine_chunks().to_batches()[0])
                    held = []
                place = (key[low], meeting[low])
                held.append(batch.slice(low, high - low))
        if held:
            yield partners(pa.Table.from_batches(held).combine_chunks().to_batches()[0])

    members = open_.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / chunk).cast("int").alias("chunks"))
    placed = _placed(open_.join(members, "key"), some.select("node", "sketch")).select("key", "meeting", "side", "node", "n", "root", "sketch")
    found = stored(placed.mapInArrow(run, "key long, a long, b long").distinct(), "minhash-partners")
    many = found.filter("b IS NULL").select("key", F.col("a").alias("node"))
    left = open_.drop("weight").join(many, ["key", "node"], "left_semi")
    left = left.join(left.groupBy("key").agg(F.sum("n").alias("weight")), "key")
    return found.filter("b IS NOT NULL").select("a", "b"), stored(left, "minhash-open")


class _Meeting:
    """Members of one key, or of two of its chunks, compared across components."""

    def __init__(self, share: int) -> None:
        self.share = share

    def links(self, nodes: list[int], roots: list[int], sides: list[int], sets: list[np.ndarray]) -> Iterator[tuple[int, int]]:
        order = sorted(range(len(sets)), key=lambda i: len(sets[i]))
        sizes = np.array([len(sets[i]) for i in order])
        nodes, sides = [nodes[i] for i in order], np.array([sides[i] for i in order])
        root = {r: r for r in roots}
        roots = [roots[i] for i in order]

        def top(r: int) -> int:
            while root[r] != r:
                root[r] = root[root[r]]
                r = root[r]
            return r

        _, numbers, counts = np.unique(np.concatenate([sets[i] for i in order]), return_inverse=True, return_counts=True)
        cuts = np.concatenate([[0], np.cumsum(sizes)])
        owner = np.repeat(np.arange(len(sizes)), sizes)
        # Of similar sets each has one of the common shingles among its first size - share * size + 1, in any one order; rare ones first.
        rare = np.lexsort((numbers, counts[numbers], owner))
        prefix = sizes - -(-self.share * sizes // 100) + 1
        early = rare[(np.arange(len(rare)) - cuts[owner]) < prefix[owner]]
        early = early[counts[numbers[early]] > 1]
        by_number = early[np.argsort(numbers[early], kind="stable")]
        postings, members = numbers[by_number], owner[by_number]
        low, high = np.searchsorted(postings, numbers[early], "left"), np.searchsorted(postings, numbers[early], "right")
        of = np.searchsorted(owner[early], np.arange(len(sizes) + 1))
        mark = np.zeros(len(counts), dtype=bool)
        for i in range(len(sizes)):
            lists = [members[a:b] for a, b in zip(low[of[i] : of[i + 1]], high[of[i] : of[i + 1]], strict=True)]
            if not lists:
                continue
            met = np.unique(np.concatenate(lists))
            met = met[(met > i) & (100 * sizes[i] >= self.share * sizes[met]) & ((sides[i] < 0) | (sides[met] != sides[i]))]
            own = numbers[cuts[i] : cuts[i + 1]]
            mark[own] = True
            for j in met.tolist():
                a, b = top(roots[i]), top(roots[j])
                if a != b and _linked(sizes[i], sizes[j], int(mark[numbers[cuts[j] : cuts[j + 1]]].sum()), self.share):
                    root[max(a, b)] = min(a, b)
                    yield nodes[i], nodes[j]
            mark[own] = False

    def run(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by (key, meeting); one meeting is held at a time."""
        place, held = None, ([], [], [], [])

        def closed() -> pa.RecordBatch:
            found = list(self.links(*held)) if held[0] else []
            return pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], pa.int64()) for i in (0, 1)], ["a", "b"])

        for batch in batches:
            columns = [batch[c].to_pylist() for c in ("key", "meeting", "node", "root", "side")]
            for key, meeting, node, root, side, hashes in zip(*columns, batch["hashes"], strict=True):
                if (key, meeting) != place:
                    yield closed()
                    place, held = (key, meeting), ([], [], [], [])
                for column, value in zip(held, (node, root, side, _hashes(hashes.as_py())), strict=True):
                    column.append(value)
        yield closed()


def _left_over(shared: DataFrame, tied: DataFrame) -> DataFrame:
    """Members of keys of three or more classes that lie in several components; of keys with equal members one."""
    members = shared.filter("c > 2").join(tied, "node", "left")
    members = members.select("key", "node", "n", F.coalesce("root", "node").alias("root"))
    facts = members.groupBy("key").agg(
        F.min("root").alias("low"), F.max("root").alias("high"), F.count(F.lit(1)).alias("c"), F.sum("n").alias("weight"),
        F.bit_xor(F.xxhash64("node")).alias("h1"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("h2"),
    ).filter("low < high")
    keys = facts.groupBy("c", "weight", "h1", "h2").agg(F.min("key").alias("key"))
    return stored(members.join(keys.select("key", "weight"), "key"), "minhash-open")


def _placed(open_: DataFrame, more: DataFrame) -> DataFrame:
    """Members dealt to meetings of two of their key's ``chunks`` at most, with what ``more`` has of each node; sorted by meeting."""
    dealt = open_.withColumn("side", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))
    dealt = dealt.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    meeting = F.least("side", "_other").cast("long") * F.lit(1 << 31) + F.greatest("side", "_other")
    # A chunk's own pairs are compared in its meeting with itself.
    own = F.when(F.col("side") == F.col("_other"), F.lit(-1)).otherwise(F.col("side"))
    dealt = dealt.select("key", meeting.alias("meeting"), own.alias("side"), "node", "n", "root").join(more, "node")
    return dealt.repartition("key", "meeting").sortWithinPartitions("key", "meeting")


def _met(open_: DataFrame, sets: DataFrame, share: int, chunk: int) -> DataFrame:
    """Links across components inside the keys that are still open."""
    placed = _placed(open_.withColumn("chunks", F.ceil(F.col("weight") / chunk).cast("int")), sets)
    return placed.select("key", "meeting", "side", "node", "root", "hashes").mapInArrow(_Meeting(share).run, "a long, b long")


def near_duplicates(
    docs: DataFrame,
    columns: Sequence[str] = ("doc_id", "text"),
    shingle: int = SHINGLE,
    share: int = SHARE,
    rows: int = ROWS,
    bands: int = BANDS,
    chunk: int = CHUNK,
    sketched: int = SKETCHES,
) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (smallest doc_id reachable over links), kept (doc_id is that).

    NULL, empty and blank texts have no shingles and are linked with nothing, not with each other either. A text of fewer
    words than a shingle is one shingle. Repeated rows each get their row. A NULL doc_id is kept only where its component
    has no other, and never names one. An empty table gives no rows. Further columns are ignored.
    """
    signatures = stored(signed(docs, columns, shingle, rows, bands), "minhash-signatures")
    classes = numbered_classes(signatures.filter("n_shingles > 0"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch"))
    keyed = stored(classes.select("node", "n", F.explode("bands").alias("key")), "minhash-keys")
    groups = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("c"), F.min("node").alias("b")).filter("c > 1")
    # All later steps need only the keys that several classes share.
    shared = stored(keyed.join(stored(groups, "minhash-groups"), "key"), "minhash-shared")
    some = stored(classes.select("node", "n", "sketch").join(shared.select("node").distinct(), "node", "left_semi"), "minhash-sketches")
    least = least_agreeing(rows * bands, share)
    pairs = shared.filter("node != b").select(F.col("node").alias("a"), "b").distinct()
    pairs = stored(likely(pairs, some, share, least), "minhash-pairs")
    sets = full_sets(docs, columns, classes, pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), shingle)
    links = stored(confirmed(pairs, sets, share), "minhash-links")
    tied = stored(components(links), "minhash-components")
    open_ = _left_over(shared, tied)
    if not open_.isEmpty():
        pairs, open_ = _partnered(open_, some, share, least, sketched)
        wanted = pairs.select(F.explode(F.array("a", "b")).alias("node")).union(open_.select("node")).distinct()
        sets = full_sets(docs, columns, classes, wanted, shingle)
        further = confirmed(pairs, sets, share)
        if not open_.isEmpty():
            further = further.union(_met(open_, sets, share, chunk))
        further = stored(further, "minhash-links")
        tied = stored(components(links.union(further)), "minhash-components")
    rooted = classes.select("set_id", "node", "first").join(tied, "node", "left").withColumn("root", F.coalesce("root", "node"))
    names = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = stored(rooted.join(names, "root").select("set_id", "component_id"), "minhash-names")
    full = signatures.filter("n_shingles > 0").select("doc_id", "n_shingles", "set_id").join(named, "set_id").drop("set_id")
    bare = signatures.filter("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return full.unionByName(bare).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
