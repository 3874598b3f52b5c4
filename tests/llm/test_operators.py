"""Each operator against brute force or held-out truth, and its defined results on odd input."""

import itertools
import random
import re
import zlib

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from tests.check_queries import compare, connect
from tidemark.llm import (
    boosting, decontamination, html_extraction, language_id, language_model, mixing, nearest, pii, quality, simhash, url_filters,
)
from tidemark.llm.components import components

SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ODD = [
    (1, None, "en", "a", None), (None, "some words of a text", None, None, 20), (3, "", "en", "a", 0), (4, " \t\n", "fr", None, 3),
    (5, "1234 !!", "en", "b", 7), (6, "one two three four five", "en", "a", 23), (6, "one two three four five", "en", "a", 23),
    (7, "lang " * 30_000, "en", "a", 150_000), (8, "naïve ünïcode  text", None, "b", 19),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="module")
def odd(spark):
    """Odd rows, with further columns whose names clash with inputs and outputs."""
    df = spark.createDataFrame(ODD, DOCS)
    return df.select("*", F.lit("x").alias("Text"), F.lit(1).alias("size"), F.lit(2).alias("doc_id"))


def plain(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


OPERATORS = {
    "quality": lambda d, s: quality.judge(d, s.createDataFrame([(6, 1), (7, 0), (None, 1), (8, None)], "doc_id long, quality int")),
    "language_model": lambda d, s: language_model.score(d),
    "language_id": lambda d, s: language_id.identify(d),
    "mixing": lambda d, s: mixing.mix(d),
    "simhash": lambda d, s: simhash.near_duplicates(d),
    "pii": lambda d, s: pii.find(d),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_rows_and_empty_tables(spark, odd, name):
    found = OPERATORS[name](odd, spark)
    assert sorted(map(repr, (r.doc_id for r in found.collect()))) == sorted(map(repr, (r[0] for r in ODD)))
    assert OPERATORS[name](odd.limit(0), spark).count() == 0


def test_components_match_union_find(spark):
    pick = random.Random(4)
    links = [(pick.randrange(60), pick.randrange(60)) for _ in range(45)]
    root = list(range(60))
    for _ in range(60):
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    found = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {n: root[n] for pair in links for n in pair if len(set(pair)) > 1} | {n: r for n, r in found.items() if r == root[n]}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_fingerprint(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    shingles = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    h = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


@pytest.mark.parametrize("chunk", [2048, 8])
def test_simhash_matches_all_pairs(spark, docs, chunk):
    """A small chunk makes every key large: chunks then meet two at a time."""
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    near = " ".join(f"word{i}" for i in range(200))
    rows += [(1000 + i, near.replace(f"word{i * 3}", "changed")) for i in range(40)] + [(2000, None), (2001, "")]
    marks = [(i, brute_fingerprint(t)) for i, t in rows]
    root = {i: i for i, _ in marks}
    for _ in range(6):
        for i, a in marks:
            for j, b in marks:
                if (a ^ b).bit_count() <= 3:
                    root[i] = root[j] = min(root[i], root[j])
    found = simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), chunk=chunk)
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in found.collect()} == {i: (f"{m:016x}", root[i]) for i, m in marks}


def test_one_of_each_keeps_the_smallest(spark):
    rows = [(3, "a b c d"), (2, "a b c d"), (None, "a b c d"), (9, "quite another text here"), (9, "quite another text here"), (None, None)]
    kept = simhash.one_of_each(spark.createDataFrame(rows, "doc_id long, text string"))
    assert plain(kept) == sorted([(2, "a b c d"), (9, "quite another text here"), (None, None)], key=repr)


@pytest.mark.parametrize("name", ["op2_url_filters", "op7_mixing"])
def test_sql(spark, name):
    assert compare(spark, connect(SMALL), name, SMALL) is None


def test_mixing_cuts_exactly_in_ranges_and_with_copies(spark):
    pick = random.Random(2)
    rows = [(i, "w " * pick.randrange(40), pick.choice(["a", "b", None]), "x", 0) for i in range(300)]
    rows += [(500, "same text", "a", "x", 0)] * 50
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, n_chars long")
    found = mixing.mix(df, range_rows=7).collect()
    assert len(found) == len(rows) and found == mixing.mix(df, range_rows=7).collect() or plain(mixing.mix(df)) == plain(mixing.mix(df, range_rows=7))
    for source in ("a", "b", None):
        own = [r for r in found if r.source == source]
        assert sum(r.taken for r in own) == int(own[0].target) and all(0 <= r.taken <= 2 * r.size for r in own)
    total = sum(r.size for r in found)
    assert abs(sum({r.source: r.target for r in found}.values()) - 1.5 * total) < 1e-6
    stage = mixing.mixed(df, range_rows=7).collect()
    for source in ("a", "b", None):
        target = next(r.target for r in found if r.source == source)
        assert abs(sum(r.taken for r in stage if r.source == source) - target) <= 51


def test_urls_by_rules(spark):
    urls = ["http://WWW.Example.com/en/x?y", "http://a.example.com/en/", "https://example.com/de/", "http://x.net/es/1", "http://net/fr/", "no scheme", None,
            "http://notexample.com/en/", "http://example.com", "http://b.org/#/en/"]
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)], "page_id long, url string, host string")
    found = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filters.judge(pages, url_filters.rule_table(spark, url_filters.RULES)).collect()}
    assert found[0] == ("www.example.com", "/en/x", "www.example.com/en/", "allow")
    assert found[1][2:] == ("example.com/en/", "block") and found[2][2:] == ("com/", "allow")
    assert found[3][2:] == ("net/es/", "block") and found[4][2:] == ("net/fr/", "block")
    assert found[5] == found[6] == ("", "", None, "allow")
    assert found[7][2:] == ("com/", "allow") and found[8] == ("example.com", "", None, "allow") and found[9][2:] == (None, "allow")
    assert url_filters.judge(pages.limit(0), url_filters.rule_table(spark, url_filters.RULES)).count() == 0
    assert url_filters.judge(pages, url_filters.rule_table(spark, [("allow", "q", "r")])).count() == len(urls)
    deep = url_filters.rule_table(spark, [("block", "b.c", "/x/y"), ("allow", "c", "/x/yz")])
    got = url_filters.judge(spark.createDataFrame([(1, "s://a.b.c/x/yzz")], "page_id long, url string"), deep).first()
    assert (got.rule, got.verdict) == ("b.c/x/y", "block")  # equal lengths: the longer host


def test_leaks_with_changed_words_are_found(spark):
    pick = random.Random(1)
    vocabulary = [f"v{i}" for i in range(3000)]
    items = [(i, " ".join(pick.choices(vocabulary, k=40))) for i in range(20)] + [(90, "too short"), (91, None), (92, "")]
    items.append((99, items[0][1]))
    clean = [(i, " ".join(pick.choices(vocabulary, k=300))) for i in range(30)]
    leaks = []
    for i in range(20):
        words = items[i][1].split()
        for j in range(4, 40, 9):
            words[j] = "changed"
        leaks.append((100 + i, f"{clean[i][1]} {' '.join(words).upper()} {clean[-1][1]}"))
    rows = [*clean, *leaks, (500, None), (501, "same " * 5000), (None, leaks[0][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = decontamination.contaminated(df, spark.createDataFrame(items, "item_id long, text string"))
    assert {(r.doc_id, r.item_id) for r in found.collect()} == {(100 + i, i) for i in range(20)} | {(None, 0)}
    kept = decontamination.without_leaks(df, spark.createDataFrame(items, "item_id long, text string"))
    assert kept.count() == len(clean) + 2
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontamination.contaminated(df, none).count() == 0
    assert decontamination.contaminated(df.limit(0), spark.createDataFrame(items, "item_id long, text string")).count() == 0


def test_every_placement_of_changed_words_has_a_hit():
    """Whole items of 10 to 12 words, and overlaps of 13 to 25; a longer one holds one of those that counts too."""
    for n in range(10, 26):
        for changed in itertools.combinations(range(n), n // 5):
            bad = sum(1 << c for c in changed)
            assert any(
                not bad & int(mask[::-1], 2) << at for mask in decontamination.MASKS for at in range(n - len(mask) + 1)
            ), (n, changed)


def test_short_and_unspaced_items_are_found(spark):
    """Held against brute force: every item laid at every place of every text."""
    pick = random.Random(5)
    kanji = [chr(0x4E00 + i) for i in range(2000)]
    vocabulary = [f"v{i}" for i in range(2000)]
    items = [(n, " ".join(pick.choices(vocabulary, k=n))) for n in range(3, 26)]
    items += [(100 + n, "".join(pick.choices(kanji, k=n))) for n in (6, 9, 10, 13, 20)]
    docs = []
    for item, text in items:
        words, joint, other = (text.split(), " ", vocabulary) if item < 100 else (list(text), "", kanji)
        for changed in range(0, len(words) // 5 + 2):
            new = list(words)
            for at in pick.sample(range(len(words)), changed):
                new[at] = "x" if item < 100 else "\u3042"
            docs.append((len(docs), joint.join([*pick.choices(other, k=50), *new, *pick.choices(other, k=50)])))

    def tokens(text):
        return re.findall("[\u3040-\u30ff\u4e00-\u9fff]|[a-z0-9]+", text)

    expected = set()
    for doc, text in docs:
        d = tokens(text)
        for item, w in ((i, tokens(t)) for i, t in items):
            if len(w) < (5 if item < 100 else 10):
                continue
            for shift in range(-len(w) + 1, len(d)):
                same = [0 <= shift + k < len(d) and d[shift + k] == w[k] for k in range(len(w))]
                least = min(13, len(w))
                share = 0.8 if len(w) >= 10 else 1
                spans = ((a, b) for a in range(len(w)) for b in range(a + least, len(w) + 1))
                if sum(same) >= share * least - 1e-9 and any(sum(same[a:b]) >= share * (b - a) - 1e-9 for a, b in spans):
                    expected.add((doc, item))
    found = decontamination.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r.doc_id, r.item_id) for r in found.collect()} == expected
    assert len(expected) > 60


@given(st.lists(st.booleans(), max_size=30))
def test_longest_overlap(same):
    same = np.array(same, dtype=bool)
    best = max([b - a for a in range(len(same)) for b in range(a + 1, len(same) + 1) if same[a:b].mean() >= 0.8 - 1e-12], default=0)
    assert decontamination.longest_overlap(same, 0.8)[0] == best


NAIVE = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda s: 16 <= len(re.sub("[ -]", "", s)) <= 19 and pii._luhn(re.sub("[ -]", "", s))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 8 <= len(re.sub("[^0-9]", "", s)) <= 15),
)


@settings(max_examples=300)
@given(st.lists(st.sampled_from([*"ab1290.@+-() _%é", "4532015112830366", "255", "300", "a@b.c", "+1 (202) 555-0100", "1.2.3.4"]), max_size=24).map("".join))
def test_strict_spans_match_plain_patterns(text):
    wanted = [(k, *m.span()) for k, (_, p, ok) in enumerate(NAIVE) for m in re.finditer(p, text) if ok(m[0])]
    assert pii.strict_spans(text) == wanted


def test_pii_adds_only_what_is_certain(spark):
    rows = [(i, f"hello mail a{i}@b.example.com or +1 (202) 555-01{i:02d} and 10.0.0.{i} end") for i in range(60)]
    rows += [(100 + i, f"order {i}234 5678 {i}111 of 12.05.{i} and 999.1.2.{i}") for i in range(60)]
    found = {r.doc_id: r for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert (found[1].n_email, found[1].n_ip, found[1].n_card, found[1].n_phone) == (1, 1, 0, 1)
    assert sum(r.spans.count(":") for i, r in found.items() if i >= 100) == 0
    assert pii.redacted("mail a@b.c now", [(0, 5, 10)]) == "mail [EMAIL] now" and pii.redacted(None, []) is None


def test_pii_adds_planted_loose_forms_and_no_look_alikes(spark):
    pick = random.Random(7)
    n = lambda a, b: pick.randint(a, b)
    rows = [(i, f"some words name{i}@mail{i % 9}.example.com then +1 ({n(201, 989)}) 555-{n(1000, 9999)} or +49 {n(20, 99)} {n(1000000, 9999999)} at {n(1, 254)}.{n(0, 255)}.{n(0, 255)}.{n(1, 254)} end") for i in range(300)]
    loose = ["(202) 555-0100", "0049 30 1234567", "jane.roe (at) site (dot) org", "john[at]site.org", "172 . 16 . 254 . 31"]
    plain = ["2024 1231 0930", "4465758382889430", "123456789", "300.12.44.7", "12, 34, 56, 78", "1,234,567", "12.05.2024"]
    rows += [(1000 + i, f"and so we say {x} to them") for i, x in enumerate(loose)] + [(2000 + i, f"and so we say {x} to them") for i, x in enumerate(plain)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.spans for r in pii.find(docs).collect()}
    kinds = ("phone", "phone", "email", "email", "ip")
    assert [found[1000 + i] for i in range(len(loose))] == [f"{k}:14:{14 + len(x)}" for k, x in zip(kinds, loose, strict=True)]
    assert not any(found[2000 + i] for i in range(len(plain)))


def test_pii_learns_from_all_examples(spark):
    pick = random.Random(3)
    at = lambda: ".".join(str(pick.randint(1, 254)) for _ in range(4))
    texts = [" ".join(f"name{pick.randint(0, 10**9)}@m{j % 7}.example.com then {at()}" for j in range(70)) for _ in range(60)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, *texts[:5], None, ""])], "doc_id long, text string")
    wanted = {}
    for told, span, label, source in (e for t in texts for e in pii.examples(t)):
        body = told[max(0, span[1] - 24) : span[2] + 2] + pii.KINDS[span[0]]
        wanted[tuple(pii.features(told, span)), label, body, pii._digest(source) % 2] = None
    assert sum(label for _, label, _, _ in wanted) > 20_000
    assert pii.learned(docs).count() == len(wanted)
    rows = [(x, label) for x, label, _, odd in wanted if not odd]
    x, y = np.array([x for x, _ in rows]), np.array([label for _, label in rows], dtype=np.int64)
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, boosting.BINS + 1)[1:-1])) for f in range(x.shape[1])]
    trees, found = boosting.fit(boosting.Held(boosting.binned(x, cuts), y, 1 - y), cuts, y.mean()), pii.fit(docs)
    assert np.allclose(trees.probability(x), found.trees.probability(x), atol=1e-9)


def test_boosting_held_and_spread_agree(spark):
    pick = np.random.default_rng(4)
    x = pick.integers(0, 9, (400, 3)).astype(float)
    yes = (x[:, 0] + x[:, 1] > pick.uniform(0, 16, 400)).astype(np.int64)
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, boosting.BINS + 1)[1:-1])) for f in range(3)]
    bins, times = boosting.binned(x, cuts), pick.integers(1, 4, 400)
    rows = [(bytearray(b.tobytes()), int(a), int(c)) for b, a, c in zip(bins, yes * times, (1 - yes) * times, strict=True)]
    spread = boosting.Spread(spark.createDataFrame(rows, "bins binary, yes long, no long").repartition(5), 3)
    held, share = boosting.Held(bins, yes * times, (1 - yes) * times), (yes * times).sum() / times.sum()
    a, b = (boosting.fit(s, cuts, share, rounds=4) for s in (held, spread))
    assert a.leaf.tobytes() == b.leaf.tobytes() and (a.bin == b.bin).all()
    assert (a.probability(x) == a.probability(bins, binned=True)).all()
    p = np.repeat(a.probability(x), times), np.repeat(yes, times)
    base = times @ yes / times.sum()
    loss = [-(p[1] * np.log(q) + (1 - p[1]) * np.log(1 - q)).mean() for q in (p[0], base)]
    assert loss[0] < 0.95 * loss[1]


@pytest.mark.parametrize("scaled", [False, True])
def test_survivors_are_those_of_plain_widening_from_any_guess(scaled, monkeypatch):
    pick = np.random.default_rng(6)
    values = pick.normal(size=(500, 20)) * (pick.uniform(0.3, 2, (500, 1)) if scaled else 1)
    order = np.argsort(values, axis=0, kind="stable")
    arrays, places = np.take_along_axis(values, order, axis=0).T.copy(), np.argsort(order, axis=0).T.astype(np.uint16)
    around = pick.normal(size=(30, 20)) * np.linspace(0.1, 3, 30)[:, None]
    wanted, stops = np.zeros((30, 500), dtype=bool), []
    for q, at in enumerate(around):
        half, step = nearest.FIRST * 0.1, 0
        while wanted[q].sum() < 100:
            wanted[q] = ((values >= at - half) & (values <= at + half)).sum(axis=1) >= 16
            half, step = half * nearest.WIDER, step + 1
        stops.append(step - 1)
    counted, search = [], np.searchsorted
    monkeypatch.setattr(nearest.np, "searchsorted", lambda a, v, **b: counted.append(len(v)) or search(a, v, **b))
    for guess in (0, 3, int(np.median(stops)), 60):
        found, step = nearest.survivors(places, arrays, around, 0.1, 21, guess)
        assert (found == wanted).all() and step == int(np.median(stops))
    # Queries that stop at the guessed step open two windows, not one for every step up to there.
    counted.clear()
    same = np.flatnonzero(np.array(stops) == stops[0])
    nearest.survivors(places, arrays, around[same], 0.1, 21, stops[0])
    assert stops[0] > 4 and sum(counted) == 2 * 2 * 20 * len(same)


def test_nearest_recall_and_odd_vectors(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(900, 24)) * rng.uniform(0.5, 2, size=(900, 1))
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(1000, None), (1020, [0.0] * 24), (1040, [float("nan")] * 24), (1060, [1.0, None]), (1080, [float("inf")] * 24), (None, x[0].tolist()), (2001, x[1].tolist())]
    found = nearest.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    ids = np.array([*range(900), 2001])
    all_ = np.vstack([x, x[1]])
    hit = 0
    for q in range(0, 900, 20):
        score = all_ @ x[q]
        score[q] = -np.inf
        top = set(ids[np.lexsort((ids, -score))[:20]].tolist())
        own = [r for r in found if r.query_id == q]
        assert [r.rank for r in own] == list(range(1, 21)) or sorted(r.rank for r in own) == list(range(1, 21))
        hit += len(top & {r.vec_id for r in own})
    assert {r.query_id for r in found} == set(range(0, 900, 20)) and hit >= 0.9 * 20 * 45
    few = spark.createDataFrame([(0, [1.0, 2.0]), (1, [2.0, 1.0]), (2, [2.0, 1.0])], "vec_id long, embedding array<float>")
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in nearest.nearest(few).orderBy("rank").collect()] == [(0, 1, 1, 4.0), (0, 2, 2, 4.0)]
    assert nearest.nearest(few.filter("vec_id = 9")).count() == 0


def test_quality_on_held_out(spark):
    sf = "/root/testdata/sf0.01"
    found = quality.judge(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet"))
    both = found.filter("held_out").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").select("quality", "predicted").collect()
    assert np.mean([r.quality == r.predicted for r in both]) > 0.93
    assert all(r.predicted == 1 for r in both if r.quality == 1)


def test_labels_of_absent_documents_take_no_place(spark, docs):
    labels = spark.read.parquet(f"{SMALL}/labels.parquet").select("doc_id", "quality")
    absent = spark.range(10**6, 10**6 + 20_000).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"))
    whole = quality.judge(docs, labels.unionByName(absent.select("doc_id", F.col("quality").cast(labels.schema["quality"].dataType))))
    assert plain(whole) == plain(quality.judge(docs, labels))


def test_language_on_held_out_and_rejection(spark, docs):
    strange = spark.createDataFrame([(9001, "これは日本語の文章です " * 200, None, None, 0)], DOCS)
    found = language_id.identify(docs.union(strange)).join(docs.select("doc_id", "lang"), "doc_id", "left").collect()
    assert np.mean([r.lang == r.lang_pred for r in found if r.held_out and r.doc_id != 9001]) > 0.97
    assert {r.doc_id for r in found if r.rejected} == {9001}


SCRIPTS = {
    "a": "The cat and the hat that sat on a mat", "b": "\U00020000\U00021000\U00020000 \U00022000\U00021000", "c": "これは日本語の文章です それは何ですか",
    "d": "кот и шляпа на коврике кот", "e": "the\u0301 ünïcode ca\u0142y tekst",
}


def kneser_ney(texts):
    """Interpolated Kneser-Ney of characters as a function (context of three, character) by plain dictionaries, and its alphabet."""
    counts = {k: {} for k in range(1, 5)}
    for text in texts:
        for word in language_id.LETTERS.findall(text.lower()):
            w = "\x02\x02\x02" + word + "\x03"
            for i in range(3, len(w)):
                counts[4][w[i - 3 : i + 1]] = counts[4].get(w[i - 3 : i + 1], 0) + 1
    for k in (3, 2, 1):
        for gram in counts[k + 1]:
            counts[k][gram[1:]] = counts[k].get(gram[1:], 0) + 1

    def p(context, char, floor):
        value = floor
        for k in range(1, 5):
            have, before = counts[k], context[4 - k :]
            ones, twos = (sum(n == m for n in have.values()) for m in (1, 2))
            off = ones / (ones + 2 * twos) if ones and twos else 0.75
            follow = {g: n for g, n in have.items() if g[:-1] == before}
            if follow:
                value = (max(follow.get(before + char, 0) - off, 0) + off * len(follow) * value) / sum(follow.values())
        return value

    return p, set(counts[1])


def test_language_entropies_match_plain_kneser_ney(spark):
    rows = [(lang, text) for lang, text in SCRIPTS.items() for _ in range(2)]
    model = language_id.fit(spark.createDataFrame(rows, "lang string, text string"))
    plain_models = {lang: kneser_ney([text, text]) for lang, text in SCRIPTS.items()}
    alphabet = set().union(*(own for _, own in plain_models.values()))
    assert model.langs == sorted(SCRIPTS) and model.floor == pytest.approx(1 / (len(alphabet) + 1))
    words = sorted({w for t in SCRIPTS.values() for w in language_id.LETTERS.findall(t.lower())} | {"hat", "\U00021000\U00021000", "кошка", "語", "zzz"})
    total, chars = model.entropies(words)
    for i, word in enumerate(words):
        w = "\x02\x02\x02" + word + "\x03"
        assert chars[i] == len(word) + 1
        for j, lang in enumerate(model.langs):
            cost = -sum(np.log(plain_models[lang][0](w[k - 3 : k], w[k], model.floor)) for k in range(3, len(w)))
            assert total[i, j] == pytest.approx(cost, rel=1e-5)
    # No distribution exceeds one: known contexts, foreign ones, and characters beyond 16 bits.
    for context in ("\x02\x02\x02", "\x02\x02t", "\x02\U00020000\U00021000", "これは"):
        for p, _ in plain_models.values():
            assert sum(p(context, c, model.floor) for c in alphabet) <= 1 + 1e-9


@pytest.mark.parametrize("entries", [0, 300])
def test_language_is_the_same_whatever_is_broadcast(spark, entries):
    extra = spark.createDataFrame([(100 + i, t, lang, None, 0) for i, (lang, t) in enumerate(SCRIPTS.items())] * 2, DOCS)
    rows = extra.union(spark.createDataFrame(ODD, DOCS))
    assert plain(language_id.identify(rows, entries=entries)) == plain(language_id.identify(rows))
    fitted = language_id.fit(rows.filter("lang IS NOT NULL").select("lang", "text"), entries)
    assert fitted.rest is not None and sum(len(g.values) for g in fitted.held.values()) <= entries


def test_language_model_base_is_exact_and_model_normalised(spark, docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    tokens = {i: [*re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t)), None] for i, t in rows}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in tokens}
    count = {}
    for i, ts in tokens.items():
        for t in ts if not held[i] else ():
            count[t] = count.get(t, 0) + 1
    n, v = sum(count.values()), len(count)
    for head in (1 << 17, 40):
        found = language_model.score(docs, head=head).collect()
        for r in found:
            base = sum(np.log10((count.get(t, 0) + 1) / (n + v + 1)) for t in tokens[r.doc_id])
            assert (r.held_out, r.n_tokens, r.train_tokens) == (held[r.doc_id], len(tokens[r.doc_id]), n)
            assert r.n_known == sum(t in count for t in tokens[r.doc_id]) and abs(base - r.base_score) < 1e-6 * abs(base)
        own = [r for r in found if r.held_out]
        assert sum(r.score for r in own) > sum(r.base_score for r in own)
    table = np.exp(language_model.train(np.eye(30) * 50 + 1).astype(np.float64))
    assert np.allclose(table.sum(axis=1), 1, atol=1e-4) and table.diagonal().min() > 0.2


PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var a="</p>";</script></head><body><nav><a href=x>Menu</a></nav>
<!-- c --><div class="ad">Buy</div>{}<div id="comments"><p>nice</p></div><form>f</form><footer>&copy; me</footer></body></html>"""


def test_articles_by_markup(spark):
    article = "<article><header><h1>A &amp; B</h1></header><p><b>one\n two<br><p>three<aside>x</aside><p>a<i>b</i>c</article>"
    rows = [(1, "http://h/a", PAGE.format(article)), (2, None, None), (3, "u", ""), (4, "u", "<p>unclosed <!-- x"), (5, "u", "1 < 2 <p>&lt;tag&gt;"), (5, "u", "<script>never closed")]
    found = plain(html_extraction.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).select("page_id", "text", "n_chars"))
    assert found == [(1, "A & B\none two\nthree\nabc", 23), (2, "", 0), (3, "", 0), (4, "unclosed", 8), (5, "", 0), (5, "1 < 2\n<tag>", 11)]
    assert html_extraction.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


@pytest.mark.parametrize(("page", "text"), [
    ('<article><div style="overflow:hidden">kept words</div></article>', ["kept words"]),
    ('<article><p>see <a href="/hidden-gems/">the gems</a> here</p></article>', ["see the gems here"]),
    ('<div data-id="nav">kept</div>', ["kept"]), ('<div data-class="ad" title="class=ad">kept</div>', ["kept"]),
    ('<div class="content-with-sidebar no-sidebar">kept</div>', ["kept"]),
    ('<article class="post has-comments"><p>kept</p></article>', ["kept"]),
    ('<article class="post comments"><p>kept</p></article>', ["kept"]),
    ('<div class="sidebar"><div class="widget">gone</div><article>kept<div class="share">gone</div></article>gone</div>', ["kept"]),
    ('<main>kept<ol class="comments"><li><article class="comment">gone</article></li></ol><div class="share-buttons">gone</div></main>', ["kept"]),
    ('<article><p class="ad">gone<p>kept</article>', ["kept"]), ('<main><ul><li class="share">gone<li>kept<ul><li>too</ul></ul></main>', ["kept", "too"]),
    ('<table><tr><td class="ad">gone<td>kept<tr class="promo"><td>gone<tr><td><p>too</table>', ["kept", "too"]),
    ('<article>kept<div class="reader-comments">gone</div><article class="related-post">gone</article></article>', ["kept"]),
    ('<div class="ad">gone</div><div id=\'cookies\'>gone</div><p hidden>gone</p><p hidden="hidden">gone</p><p aria-hidden=true>gone</p>kept', ["kept"]),
])
def test_names_and_attributes_are_whole(page, text):
    found = html_extraction.blocks(page)
    assert [t for role, t in found if role == html_extraction._wanted([role for role, _ in found])] == text


def test_repeated_blocks_of_a_host_go(spark):
    line = "every page of this host carries the very same long line of words"
    rows = [(i, "http://h.org/p", f"<div>{line}</div><div>{' '.join(f'own{i}w{j}' for j in range(30))}</div>") for i in range(6)]
    rows += [(10, "http://else.org/", f"<div>{line}</div>"), (11, "http://m.org/", "<div>" + "mirror words " * 20 + "</div>"), (12, "http://m.org/", "<div>" + "mirror words " * 20 + "</div>")]
    found = {r.page_id: r.text for r in html_extraction.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(found[i].startswith(f"own{i}w0") for i in range(6)) and found[10] == line
    assert found[11] == found[12] == ("mirror words " * 20).strip()


def test_lines_repeated_in_the_articles_of_a_host_go(spark):
    line = "get the weekly letter of this paper in your box every single friday"
    own = {i: [" ".join(f"p{i}b{b}w{j}" for j in range(30)) for b in range(2)] for i in range(40)}
    quote = "these very words are quoted by no more than two pages of it"
    rows = [(i, "http://n.org/p", f"<article><p>{own[i][0]}</p><p>{line}</p><p>{own[i][1]} {line} tail{i}</p><p>{quote if i < 2 else ''}</p></article>") for i in range(40)]
    # An article under two addresses with other surroundings is one content; two versions of a text are no evidence.
    rows += [(50 + i, "http://one.org/", f"<nav>at {i}</nav><article>{own[0][0]}</article>") for i in range(4)]
    rows += [(60 + i, "http://two.org/", f"<article><p>{own[0][0]}</p><p>version {i}</p></article>") for i in range(2)]
    # The next block's first word is the same by chance and stays.
    rows += [(70 + i, "http://the.org/", f"<div>{line}</div><div>The {own[i][0]}</div>") for i in range(4)]
    found = {r.page_id: r.text for r in html_extraction.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i in range(40):
        assert found[i] == "\n".join([own[i][0], f"{own[i][1]} tail{i}", *[quote] * (i < 2)])
    assert {found[50 + i] for i in range(4)} == {own[0][0]} and found[61] == f"{own[0][0]}\nversion 1"
    assert [found[70 + i] for i in range(4)] == [f"The {own[i][0]}" for i in range(4)]


def test_substrings_of_a_host_in_many_chunks(spark, monkeypatch):
    rng = random.Random(4)
    line = " ".join(f"line{j}" for j in range(9))
    rows = [(i, "http://big.org/", f"<article><p>{' '.join(f'w{rng.random()}' for _ in range(20))}<p>{line if i % 10 == 0 else ''}</article>") for i in range(200)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    whole = plain(html_extraction.extract(pages).select("page_id", "text"))
    monkeypatch.setattr(html_extraction, "CHUNK_TOKENS", 300)
    assert plain(html_extraction.extract(pages).select("page_id", "text")) == whole
    assert not any("line0" in text for _, text in whole)


@pytest.fixture(scope="module")
def planted(spark):
    """Pages whose text is known: three hosts with notices in and around the articles, quotations and a host of long pages."""
    pick = random.Random(8)
    rows, truth = [], {}
    for host, n in (("a.org", 30), ("b.org", 90), ("long.org", 40)):
        notice = " ".join(f"{host}{j}" for j in range(14))
        quote = " ".join(f"quote{host}{j}" for j in range(20))
        for i in range(n):
            own = [" ".join(f"x{pick.randrange(10**6)}" for _ in range(2000 if host == "long.org" else 25)) for _ in range(3)]
            own[1] += f" {quote} end{i}" if i % 10 == 0 else ""
            page = len(rows)
            rows.append((page, f"http://{host}/{i}", f"<div>{notice} menu</div><article><p>{own[0]}<p>{notice}<p>{own[1]}<p>{own[2]}</article>"))
            truth[page] = "\n".join(own)
    return spark.createDataFrame(rows, "page_id long, url string, html string"), truth


@pytest.mark.parametrize("held", [html_extraction.HELD_NAMES, 0])
def test_known_texts_lose_notices_and_no_words(spark, planted, monkeypatch, held):
    """Precision and recall of words are 1, whether substrings are held by tasks or joined, and in one chunk or several."""
    monkeypatch.setattr(html_extraction, "HELD_NAMES", held)
    monkeypatch.setattr(html_extraction, "CHUNK_TOKENS", 5_000)
    monkeypatch.setattr(html_extraction, "CHUNK_CONTENTS", 25)
    pages, truth = planted
    assert {r.page_id: r.text for r in html_extraction.extract(pages).collect()} == truth


def test_repeated_runs_match_brute_force(spark):
    """Every window of eight words, counted by host in plain Python, cuts what the operator cuts."""
    pick = random.Random(6)
    pages = []
    for i in range(60):
        w = [f"w{pick.randrange(3000)}" for _ in range(120)]
        for _ in range(4):
            at, k = pick.randrange(100), pick.randrange(6)
            w[at:at] = [f"run{k}w{j}" for j in range(7 + k)]
        pages.append(w)
    on = {}
    for i, w in enumerate(pages):
        for j in range(len(w) - 7):
            on.setdefault(tuple(w[j : j + 8]), set()).add(i)
    expected = {}
    for i, w in enumerate(pages):
        gone = {k for j in range(len(w) - 7) if len(on[tuple(w[j : j + 8])]) >= 3 for k in range(j, j + 8)}
        expected[i] = " ".join(x for k, x in enumerate(w) if k not in gone)
    rows = [(i, "http://r.org/", f"<div>{' '.join(w)}</div>") for i, w in enumerate(pages)]
    found = html_extraction.extract(spark.createDataFrame(rows, "page_id long, url string, html string"))
    assert {r.page_id: r.text for r in found.collect()} == expected


def test_chunks_of_few_long_pages_propose_nothing(spark, tmp_path):
    """Pages with nothing in common have no frequent substrings, however long they are."""
    rows = [(i, "http://l.org/", " ".join(f"p{i}w{j}" for j in range(9000))) for i in range(40)]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(str(tmp_path / "p"))
    made = []
    keep = html_extraction.stored
    try:
        html_extraction.stored = lambda df, purpose: made.append((purpose, keep(df, purpose))) or made[-1][1]
        html_extraction.extract(spark.read.parquet(str(tmp_path / "p"))).count()
    finally:
        html_extraction.stored = keep
    assert dict(made)["page-substrings"].count() == 0


def test_suffix_classes_match_brute_force():
    pick = np.random.default_rng(3)
    tokens, page = pick.integers(0, 3, 200), np.repeat(np.arange(4), 50)
    order, rank = html_extraction.suffix_classes(tokens, page, 4)
    of = dict(zip(order.tolist(), rank.tolist(), strict=True))
    whole = [i for i in range(200) if i + 3 < 200 and page[i] == page[i + 3]]
    for i in whole:
        for j in whole:
            assert (of[i] == of[j]) == (tokens[i : i + 4].tolist() == tokens[j : j + 4].tolist())


def test_pipeline_by_stages(spark, odd):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    marks = {r.doc_id: r.component_id for r in simhash.near_duplicates(docs).collect()}
    bad = {r.doc_id for r in decontamination.contaminated(docs, spark.read.parquet(f"{SMALL}/benchmark.parquet")).collect()}
    out = {r.doc_id: r for r in corpus_pipeline.run(spark, SMALL).collect()}
    firsts = {i for i, c in marks.items() if i == c}
    assert set(out) <= firsts - bad and len(out) > 0.7 * len(firsts - bad)
    assert not any(pii.strict_spans(r.text) for r in out.values())
    rows = spark.createDataFrame(ODD, DOCS)
    for name, stage in corpus_pipeline.STAGES:
        done = stage(spark, rows, SMALL)
        assert done.columns[:5] == rows.columns and stage(spark, rows.limit(0), SMALL).count() == 0, name
        assert done.count() <= len(ODD)
