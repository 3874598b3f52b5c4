"""Memory of Python workers and of broadcasts, which the pipeline's stages share with an executor's heap."""

import os
import random
import re
import tracemalloc
from urllib.parse import urlparse

import numpy as np

from tidemark.llm import common, components, language_id, simhash


def peak_mb(work):
    tracemalloc.start()
    try:
        return work(), tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_a_key_of_near_copies_is_compared_a_few_rows_at_a_time():
    pick = np.random.default_rng(1)
    base = pick.integers(0, 2**63, simhash.WIDE, dtype=np.uint64)
    marks = base ^ (np.uint64(1) << pick.integers(0, 60, (2000, simhash.WIDE)).astype(np.uint64))
    roots, sides = np.arange(2000) % 1000, np.full(2000, -1)
    (later, earlier), most = peak_mb(lambda: simhash.close_pairs(marks, roots, sides, 20, True))
    assert later.tolist() == list(range(1, 2000)) and earlier.tolist() == [0] * 999 + [1] + [0] * 999
    assert most < 15
    some = np.arange(300)
    later, earlier = simhash.close_pairs(marks[some], some, sides[some], 20, False)
    assert set(zip(later.tolist(), earlier.tolist(), strict=True)) == {(i, j) for i in range(300) for j in range(i)}


def test_words_are_scored_a_few_at_a_time():
    pick = random.Random(3)
    words = sorted({"".join(pick.choices("abcdefghijklmnopqrstuvwxyzäöü", k=8)) for _ in range(70_000)})
    model = language_id.Model(["a", "b", "c", "d"], 0.01, {})
    (total, chars), most = peak_mb(lambda: model.entropies(words))
    assert most < 25 and chars.tolist() == [9] * len(words)
    assert np.allclose(total, -9 * np.log(0.01))


def test_per_language_joins_are_keyed_by_numbers(spark):
    """A broadcast keyed by text or by several columns takes a whole memory page of every executor; one keyed by a number does not."""
    grams = spark.createDataFrame([(0, 0, 97, 2), (0, 0, 98, 1), (1, 0, 97, 3)], "at int, high long, low long, n long")
    for order in range(1, language_id.ORDER):
        for part in language_id._smoothed(grams, order):
            plan = part._jdf.queryExecution().executedPlan().toString()
            keys = re.findall(r"(?:BroadcastHashJoin|SortMergeJoin) \[([^\]]*)\], \[([^\]]*)\]", plan)
            assert keys and all("," not in a and a.startswith(("at#", "context#")) for a, _ in keys), plan


def test_rounds_of_components_write_few_files(spark, monkeypatch):
    """Each file of a local folder costs its executor a process (its permissions), however few rows it holds."""
    written = []

    def noted(df, purpose):
        df = stored(df, purpose)
        written.append(len(df.inputFiles()))
        return df

    stored = components.stored
    monkeypatch.setattr(components, "stored", noted)
    links = spark.createDataFrame([(i + 1, i) for i in range(3000) if i % 30], "a long, b long")
    held = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "61")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        found = components.components(links).collect()
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)
    assert {(r.node, r.root) for r in found} == {(i, (i - 1) // 30 * 30 + 1) for i in range(1, 3001)}
    assert len(written) > 2 and max(written[1:]) <= 2 * spark.sparkContext.defaultParallelism < written[0]


def test_models_of_languages_are_made_order_by_order(spark, monkeypatch):
    """Stages and broadcasts that one query starts at once are what the driver's heap grows by."""
    exchanges = []

    def noted(df, purpose):
        if purpose == "char-model":
            exchanges.append(len(re.findall(r"\bExchange ", df._jdf.queryExecution().executedPlan().toString())))
        return stored(df, purpose)

    stored = language_id.stored
    monkeypatch.setattr(language_id, "stored", noted)
    docs = spark.createDataFrame([("de", "der hund und die katze"), ("en", "the dog and the cat"), ("en", "a dog")], "lang string, text string")
    model = language_id.fit(docs)
    assert len(exchanges) == language_id.ORDER and max(exchanges) <= 12, exchanges
    assert model.langs == ["de", "en"] and sorted(model.held) == list(range(1, 2 * language_id.ORDER + 1)) and model.rest is None
    parts = language_id.fit(docs, held=0)
    assert not parts.held and parts.rest.count() == sum(len(g.keys) for g in model.held.values())


def test_work_tables_hold_rows_only(spark):
    """A marker of success costs the driver a process in a local folder, which counts its memory a second time for a moment."""
    made = common.stored(spark.range(10), "marked")
    names = os.listdir(os.path.dirname(urlparse(made.inputFiles()[0]).path))
    assert made.count() == 10 and names and not [n for n in names if "SUCCESS" in n], names
