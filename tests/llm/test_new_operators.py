"""Periodic runs, SuperMinHash near-duplicates and centroid clustering against brute force, and their odd input."""

import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.check_queries import compare, connect
from tidemark.llm import clustering, minhash, queries, repeats

SMALL = "/root/testdata/sf0.001"
ODD = [(1, None), (None, "some words of a text"), (3, ""), (4, " \t\n"), (6, "one two three"), (6, "one two three"), (7, "lang " * 30_000), (8, "naïve ünïcode x  text"), (9, "two words")]


@pytest.fixture(scope="module")
def odd(spark):
    df = spark.createDataFrame(ODD, "doc_id long, text string")
    return df.select("*", F.lit("x").alias("TEXT"), F.lit(1).alias("node"), F.lit(2).alias("doc_id"), F.lit(3).alias("n_words"))


def brute_runs(s, shortest):
    found = []
    for p in range(1, len(s) // 2 + 1):
        i = 0
        while i + p < len(s):
            j = i
            while j + p < len(s) and s[j] == s[j + p]:
                j += 1
            n = j - i + p
            if n >= max(2 * p, shortest) and all(any(s[x] != s[x + q] for x in range(i, i + n - q)) for q in range(1, p)):
                found.append((i, n, p))
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


BLOCK = st.tuples(st.lists(st.integers(0, 4), max_size=14), st.integers(1, 7))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(BLOCK, max_size=6).map(lambda bs: [w for b, n in bs for w in b * n]), min_size=1, max_size=6), st.sampled_from([2, 12]))
def test_runs_are_those_of_all_periods(documents, shortest):
    found = repeats.runs_of([np.array(d, dtype=np.int64) for d in documents], shortest)
    assert [[tuple(r) for r in f.tolist()] for f in found] == [brute_runs(d, shortest) for d in documents]


def test_runs_of_structured_words():
    fibonacci, following = [0], [0, 1]
    while len(following) < 300:
        fibonacci, following = following, following + fibonacci
    thue_morse = [i.bit_count() % 2 for i in range(300)]
    for s in (fibonacci, thue_morse, [0] * 200, [0, 1] * 90 + [2] + [0, 1] * 7, list(range(100)) * 3 + [1]):
        assert [tuple(r) for r in repeats.runs_of([np.array(s)], 2)[0].tolist()] == brute_runs(s, 2)


def test_periodic_runs_query_matches_brute_force(spark):
    found = {r.doc_id: tuple(r)[1:] for r in queries.op11_periodic_runs(spark, SMALL).collect()}
    compared = 0
    for d in spark.read.parquet(f"{SMALL}/documents.parquet").collect():
        w = re.findall(r"[^\x20\x09-\x0D]+", d.text or "")
        n, h = len(w), zlib.crc32(str(d.doc_id).encode())
        if n > 1000:
            continue
        if h % 10 == 0 and n:
            g, whole = h // 10, list(w)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [whole[i] if i < a else whole[a + (i - a) % p] for i in range(n)]
        runs = brute_runs(w, 12)
        best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
        gone = {i for s, length, q in runs for i in range(s + q, s + length)}
        lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        first = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        assert found[d.doc_id] == (len(runs), *first, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())
        compared += bool(runs)
    assert compared > 10


def test_runs_of_odd_rows(spark, odd):
    found = repeats.find_runs(odd).collect()
    assert sorted(map(repr, (r.doc_id for r in found))) == sorted(map(repr, (r[0] for r in ODD)))
    by_id = {r.doc_id: r for r in found}
    assert (by_id[1].n_words, by_id[1].runs, by_id[1].collapsed) == (0, [], "") and by_id[4].collapsed == ""
    assert [tuple(r) for r in by_id[7].runs] == [(0, 30_000, 1)] and by_id[7].collapsed == "lang"
    assert by_id[8].n_words == 3 and by_id[8].collapsed == "naïve ünïcode x text"
    assert repeats.find_runs(odd.limit(0)).count() == 0
    # Searched alone or beside others, a document has the same runs.
    many = spark.createDataFrame([(i, "a b c " * 5 + f"w{i} " + "d " * 13) for i in range(40)], "doc_id long, text string")
    assert {tuple(tuple(x) for x in r.runs) for r in repeats.find_runs(many, slice_words=1).collect()} == {((0, 15, 3), (16, 13, 1))}
    assert {tuple(tuple(x) for x in r.runs) for r in repeats.find_runs(many).collect()} == {((0, 15, 3), (16, 13, 1))}
    assert {r.text for r in repeats.with_planted_runs(odd).filter("doc_id is null").collect()} == {"some words some words some"}
    assert repeats.with_planted_runs(odd).count() == len(ODD)


def classes_by_all_pairs(rows, share=85):
    sets = {i: set(minhash.shingle_set(t).tolist()) for i, t in rows}
    root = {i: i for i in sets}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in itertools.combinations(sets, 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= share * len(sets[a] | sets[b]):
            x, y = sorted((top(a), top(b)))
            root[y] = x
    return {i: (i, len(s), top(i), top(i) == i) for i, s in sets.items()}


@pytest.mark.parametrize("chunk", [1_000_000, 600])
def test_minhash_matches_all_pairs(spark, chunk):
    """Chains whose ends are not alike leave keys with several components, which small chunks cut into meetings."""
    pick = random.Random(5)
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    base = [f"word{i}" for i in range(150)]
    for i in range(60):
        base[2 * i + 1] = f"new{i}"
        rows.append((1000 + i, " ".join(base)))
    for i in range(80):
        rows.append((2000 + i, " ".join(w if pick.random() > 0.02 else f"x{pick.random()}" for w in base)))
    rows += [(3000 + i, t) for i, t in enumerate(["a", "A", "a b", "a b c", "a b c d", None, "", " ", "b a"])]
    pick.shuffle(rows)
    found = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), chunk=chunk).collect()
    assert {r.doc_id: tuple(r) for r in found} == classes_by_all_pairs(rows)


def test_a_meeting_finds_every_link():
    pick = random.Random(8)
    for _ in range(40):
        pool = [pick.sample(range(60), pick.randint(1, 40)) for _ in range(4)]
        sets = [np.array(sorted({x if pick.random() > 0.06 else pick.randrange(60) for x in pick.choice(pool)}), dtype=np.uint64) for _ in range(24)]
        wanted = classes_of_links(range(24), [(a, b) for a, b in itertools.combinations(range(24), 2) if minhash._linked(len(sets[a]), len(sets[b]), len(np.intersect1d(sets[a], sets[b])), 85)])
        meeting = minhash._Meeting(85)
        assert classes_of_links(range(24), meeting.links(list(range(24)), list(range(24)), [-1] * 24, sets)) == wanted
        sides = [i % 2 for i in range(24)]
        across = [(a, b) for a, b in itertools.combinations(range(24), 2) if sides[a] != sides[b] and minhash._linked(len(sets[a]), len(sets[b]), len(np.intersect1d(sets[a], sets[b])), 85)]
        assert classes_of_links(range(24), meeting.links(list(range(24)), list(range(24)), sides, sets)) == classes_of_links(range(24), across)


def classes_of_links(nodes, links):
    root = {n: n for n in nodes}
    for a, b in links:
        low, high = sorted((root[a], root[b]))
        root = {n: low if r == high else r for n, r in root.items()}
    return root


def test_signatures_estimate_similarity_and_miss_few():
    rng = np.random.default_rng(3)
    draws = rng.integers(0, 2**63, 400_000).astype(np.uint64).reshape(400, 1000)
    for common, own in ((850, 75), (17, 2), (1, 0)):
        sets = [s for d in draws for s in (d[: common + own], np.concatenate([d[:common], d[common + own : common + 2 * own]]))]
        signatures = minhash.superminhash(sets, 120)
        agree = (signatures[::2] == signatures[1::2]).mean(axis=1)
        j = common / (common + 2 * own)
        assert abs(agree.mean() - j) < 0.01 and agree.var() <= j * (1 - j) / 120 * 1.1 + 1e-12
        keys = minhash.band_keys(signatures, 5)
        if j > 0.84:
            assert (keys[::2] == keys[1::2]).any(axis=1).all()
    # Less variance than independent hashes give where the signature is longer than the set.
    assert minhash.superminhash([np.empty(0, dtype=np.uint64)], 8).min() == 2**64 - 1


def test_sketches_tell_unlike_classes_apart_and_lose_no_pair():
    least = minhash.least_agreeing(120, 85)
    assert 72 <= least <= 80 and minhash.least_agreeing(120, 100) == 120
    pick = np.random.default_rng(8)
    for common, own in ((6, 1), (17, 3), (340, 60)):
        agree = []
        for _ in range(150):
            values = pick.integers(0, 2**63, common + own, dtype=np.uint64)
            a, b = minhash.sketches(minhash.superminhash([values[:common], values], 120))
            agree.append(int((a == b).sum()))
        assert min(agree) >= least
    unlike = [pick.integers(0, 2**63, 300, dtype=np.uint64) for _ in range(2)]
    unlike[1][:200] = unlike[0][:200]
    a, b = minhash.sketches(minhash.superminhash(unlike, 120))
    assert (a == b).sum() < least


@pytest.mark.parametrize("sketched", [3, 4096])
def test_open_keys_send_likely_pairs_or_members(spark, sketched):
    pick = random.Random(5)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(40):
        w = base[:]
        for _ in range(pick.choice([0, 1, 2])):
            w[pick.randrange(60)] = f"x{i}"
        rows.append((i, " ".join(w)))
    # Equal rows do not double a set.
    rows += [rows[7], rows[7], (50, "other words altogether")]
    sets = {i: set(minhash.shingle_set(t).tolist()) for i, t in rows}
    wanted = classes_of_links(list(sets), [(a, b) for a, b in itertools.combinations(sets, 2) if 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])])
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = minhash.near_duplicates(docs, sketched=sketched).collect()
    assert len(found) == len(rows) and {r.doc_id: r.component_id for r in found} == wanted
    # One key with all classes, each a component of its own: few likely pairs go as pairs, many as members.
    signatures = minhash.signed(docs, ("doc_id", "text"), 3, 5, 24).dropDuplicates(["doc_id"])
    some = signatures.select(F.col("doc_id").alias("node"), F.col("n_shingles").alias("n"), "sketch")
    likely = {(b, a) for a, b in itertools.combinations(sorted(sets), 2) if 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])}
    for ids, as_pairs in ((list(range(40)), False), ([max(likely)[0], max(likely)[1], 50], True)):
        open_ = spark.createDataFrame([(1, i, len(sets[i]), i, 1) for i in ids], "key long, node long, n long, root long, weight long")
        pairs, left = minhash._partnered(open_, some, 85, minhash.least_agreeing(120, 85), 4096)
        pairs, members = {tuple(r) for r in pairs.collect()}, {r.node for r in left.collect()}
        if as_pairs:
            assert max(likely) in pairs and not members
        else:
            assert not pairs and members >= {i for p in likely for i in p if i < 40}


def test_minhash_of_odd_rows(spark, odd):
    found = minhash.near_duplicates(odd).collect()
    assert sorted(map(repr, (r.doc_id for r in found))) == sorted(map(repr, (r[0] for r in ODD)))
    by_id = {r.doc_id: tuple(r)[1:] for r in found}
    assert by_id[1] == (0, 1, True) and by_id[3] == (0, 3, True) and by_id[6] == (1, 6, True) and by_id[7] == (1, 7, True)
    assert by_id[None] == (3, None, True) and by_id[9] == (1, 9, True)
    assert minhash.near_duplicates(odd.limit(0)).count() == 0
    twins = spark.createDataFrame([(None, "a b c d"), (5, "A b c d"), (5, "x y z"), (2, None)], "doc_id long, text string")
    assert sorted(map(repr, map(tuple, minhash.near_duplicates(twins).collect()))) == sorted(
        map(repr, [(None, 2, 5, False), (5, 2, 5, True), (5, 1, 5, True), (2, 0, 2, True)])
    )


def test_clusters_agree_with_sql(spark):
    assert compare(spark, connect(SMALL), "op13_clustering", SMALL) is None


def brute_clusters(rows, k, rounds, scale=64):
    kept = [(i, [math.floor(scale * float(x)) for x in v]) for i, v in rows]
    ranked = sorted(kept, key=lambda r: (hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centroids = [v for _, v in ranked[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(centroids))

    for _ in range(rounds):
        own = [[v for _, v in kept if nearest(v)[1] == j] for j in range(len(centroids))]
        centroids = [[sum(x) // len(vs) for x in zip(*vs, strict=True)] if vs else c for vs, c in zip(own, centroids, strict=True)]
    return centroids, sorted((repr(i), nearest(v)[1], nearest(v)[0]) for i, v in kept)


def test_clusters_match_brute_force_and_odd_vectors(spark):
    rng = np.random.default_rng(2)
    spread = rng.normal(size=(8, 8)) * [9, 5, 3, 1, 1, 0.1, 0, 0]
    rows = [(i, (spread[i % 8] + rng.normal(size=8) * 0.2).tolist()) for i in range(200)]
    rows += [(300, rows[0][1]), (300, rows[0][1]), (300, rows[5][1]), (None, rows[1][1]), (301, [0.0] * 8), (302, [-0.001] * 8), (303, [1e5] * 8)]
    lost = [(400, None), (401, [1.0] * 7), (402, [float("nan")] * 8), (403, [1.0] * 7 + [None]), (404, [float("-inf")] * 8), (405, [])]
    df = spark.createDataFrame(rows + lost, "vec_id long, embedding array<double>")
    df = df.select("*", F.lit(1).alias("Embedding"), F.lit(2).alias("rank"))
    for leading in (3, 8, 20):
        found = clustering.cluster(df, dimensions=8, k=5, leading=leading).collect()
        centroids, wanted = brute_clusters(rows, 5, 3)
        assert sorted((repr(r.vec_id), r.cluster, r.distance) for r in found) == wanted
        assert all(r.centroid == centroids[r.cluster] for r in found)
        assert {r.inertia for r in found} == {sum(w[2] for w in wanted)}
        assert all(r.cluster_inertia == sum(w[2] for w in wanted if w[1] == r.cluster) for r in found)
    few = clustering.cluster(df.limit(3), dimensions=8, k=5).collect()
    assert sorted((repr(r.vec_id), r.cluster, r.distance) for r in few) == brute_clusters(rows[:3], 5, 3)[1]
    assert clustering.cluster(df.limit(0), dimensions=8).count() == 0
    assert clustering.cluster(df.filter("vec_id >= 400"), dimensions=8).count() == 0
    huge = spark.createDataFrame([(i, [1e300 * (-1) ** i] * 64) for i in range(40)], "vec_id long, embedding array<double>")
    assert {r.distance for r in clustering.cluster(huge, k=1).collect()} == {64 * clustering.LARGEST**2}


def test_bounds_spare_distances_and_decide_nothing():
    rng = np.random.default_rng(4)
    spots = rng.normal(size=(16, 64)) * np.geomspace(400, 4, 64)
    x = np.floor(spots[rng.integers(0, 16, 3000)] + rng.normal(size=(3000, 64)) * 20).astype(np.int64)
    centroids = np.floor(spots).astype(np.int64)
    mean = x.mean(axis=0)
    axes = np.linalg.eigh(np.cov(x.T))[1][:, ::-1]
    lead, rest = clustering.rotated(x, mean, axes, 16)
    number, distance, measured = clustering.nearest_centroids(x, lead.astype(np.float32), rest.astype(np.float32), centroids, clustering.rotated(centroids, mean, axes, 16))
    plain = ((x[:, None, :] - centroids[None]) ** 2).sum(axis=2)
    assert (number == plain.argmin(axis=1)).all() and (distance == plain.min(axis=1)).all()
    assert measured < 0.2 * plain.size
