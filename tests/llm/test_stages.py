"""Pipeline stages on odd rows and clashing columns, and the near-duplicate stage against all pairs."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.test_operators import DOCS, ODD
from tidemark.llm import minhash, simhash

CLASHING = ("TEXT", "_bad", "_size", "_place", "_hash", "_id", "_doc", "_text", "text", "_0", "_1", "words_taken", "Source")


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES])
def test_stages_keep_clashing_columns(spark, name, tmp_path):
    stage = dict(corpus_pipeline.STAGES)[name]
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select(*[c.split()[0] for c in DOCS.split(", ")])
    docs = rows.unionByName(spark.createDataFrame(ODD, DOCS))
    wide = docs.select("*", *[F.lit(f"{c} of {i}").alias(c) for i, c in enumerate(CLASHING)])
    found = stage(spark, wide, "/root/testdata/sf0.001")
    more = ["taken"] if name == "mixing" else []
    assert found.columns == [*docs.columns, *CLASHING, *more]
    named = found.toDF(*docs.columns, *[f"c{i}" for i in range(len(CLASHING))], *more)
    plain = stage(spark, docs, "/root/testdata/sf0.001")
    same = [*docs.columns, *more]
    assert sorted(map(repr, named.select(*same).collect())) == sorted(map(repr, plain.select(*same).collect())) != []
    assert named.filter(F.lit(False) | (F.col("c0") != "TEXT of 0") | (F.col("c8") != "text of 8")).count() == 0
    assert stage(spark, wide.limit(0), "/root/testdata/sf0.001").count() == 0


def test_near_copies_at_eighty_percent_are_found(spark):
    """Of pairs by all-pairs Jaccard at 0.8 or more, at least nine in ten end in one component, and no component is looser."""
    pick = random.Random(12)
    vocabulary = [f"v{i}" for i in range(4000)]
    rows = []
    for i in range(150):
        words = pick.choices(vocabulary, k=pick.choice([60, 150, 400]))
        rows.append((2 * i, " ".join(words)))
        for _ in range(max(1, int(len(words) * pick.choice([0.0, 0.005, 0.01, 0.02, 0.03])))):
            words[pick.randrange(len(words))] = f"new{pick.random()}"
        rows.append((2 * i + 1, " ".join(words).upper()))
    group = pick.choices(vocabulary, k=300)
    rows += [(1000 + i, " ".join(w if pick.random() > 0.01 else f"x{pick.random()}" for w in group)) for i in range(60)]
    rows += [(2000, "one two three"), (2001, "ONE two three"), (2002, "one two three four")]
    sets = {i: set(minhash.shingle_set(t, 5).tolist()) for i, t in rows}
    wanted = {(a, b) for a, b in itertools.combinations(sets, 2) if len(sets[a] & sets[b]) * 100 >= 80 * len(sets[a] | sets[b])}
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found, roots = simhash.similar(docs, ("doc_id", "text"), 5, 80, 0.03, 20)
    root = {r.doc_id: r.root for r in found.join(roots, "set_id").select("doc_id", "root").collect()}
    hit = sum(root[a] == root[b] for a, b in wanted)
    assert len(wanted) > 150 and hit >= 0.9 * len(wanted)
    group_of = {i: i for i in sets}
    for a, b in wanted:
        old, new = group_of[b], group_of[a]
        group_of = {i: new if g == old else g for i, g in group_of.items()}
    assert all(group_of[a] == group_of[b] for a, b in itertools.combinations(sets, 2) if root[a] == root[b])
    kept = {r.doc_id for r in simhash.one_of_each(docs).collect()}
    assert kept == {min(i for i in root if root[i] == r) for r in set(root.values())}


def test_every_partner_of_a_key_is_met(spark, monkeypatch):
    """All sets in one key of one table, cut into chunks or not: each pair at 80 percent is found, whatever stands between."""
    pick = random.Random(5)
    vocabulary = [f"v{i}" for i in range(4000)]
    rows = [(i, " ".join(pick.choices(vocabulary, k=200))) for i in range(60)]
    for i in range(60):
        words = rows[i][1].split()
        words[pick.randrange(len(words))] = f"new{i}"
        rows.append((100 + i, " ".join(words)))
    monkeypatch.setattr(simhash, "tables_for", lambda rows, share, miss: (1, 0))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for chunk in ({}, {"chunk": 16}):
        found, roots = simhash.similar(docs, ("doc_id", "text"), 5, 80, 0.03, 64, **chunk)
        root = {r.doc_id: r.root for r in found.join(roots, "set_id").select("doc_id", "root").collect()}
        assert all(root[i] == root[100 + i] for i in range(60)) and len(set(root.values())) == 60
