"""Heavy-hitter joins, digest trees, lineage, rolled-up KPIs, many terms and unreadable lines."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import comparison, difference, documents, joins, lineage, rollups
from tidemark.operators.contracts import GateFailed
from tidemark.schemas import contract
from tidemark.sources import files


def test_only_heavy_keys_leave_the_plain_path(spark):
    facts = spark.range(60_000).selectExpr("CASE WHEN id % 3 = 0 THEN 7 WHEN id % 3 = 1 AND id % 2 = 0 THEN NULL ELSE id END AS k", "id AS v")
    dimension = spark.range(0, 60_000, 7).selectExpr("id AS k", "id * 2 AS w").unionByName(spark.createDataFrame([(7, 1), (7, 2)], "k LONG, w LONG"))
    heavy = joins.heavy_hitters(facts, ["k"])
    # NULL is heavy too, and matches nothing on either path.
    names = {r[0] for r in spark.createDataFrame([(7,), (None,)], "k LONG").select(F.xxhash64("k")).collect()}
    assert set(heavy) == names
    plain = facts.join(dimension, "k")
    for rows in (joins.BROADCAST_ROWS, 1):  # 1: the heavy rows of the dimension are too many to broadcast, so they are salted
        joined = joins.heavy_hitter_join(facts, dimension, ["k"], F.col("v"), salts=5, max_rows=rows)
        assert joined.count() == plain.count() and joined.exceptAll(plain).count() == 0
    text = joined._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("Generate explode") == 1 and text.index("Generate explode") < text.rindex("IN (")
    assert joins.heavy_hitter_join(facts.filter("k > 60"), dimension, ["k"], F.col("v"), 5).count() == plain.filter("k > 60").count()
    assert joins.heavy_hitter_join(facts.limit(0), dimension, ["k"], F.col("v"), 5).count() == 0
    with pytest.raises(ValueError):
        joins.heavy_hitters(facts, ["k"], share=1e-5)


def test_broadcast_is_bounded_in_bytes(spark):
    wide = spark.range(50).selectExpr("id", "repeat('x', 10000) AS text")
    assert joins.is_small(wide) and not joins.is_small(wide, max_bytes=400_000) and not joins.is_small(wide, max_rows=49)


def test_row_differences_read_differing_leaves_only(spark, tmp_path):
    left = spark.range(3000).selectExpr("id AS k", "id % 7 AS v", "'run' AS pipeline_run_id")
    right = left.filter("k % 500 <> 3").withColumn("v", F.when(F.col("k") % 700 == 5, -1).otherwise(F.col("v")))
    right = right.unionByName(left.filter("k IN (9, 10)")).unionByName(left.filter("k = 11").withColumn("k", F.lit(None).cast("long")))
    paths = {}
    for name, df in (("left", left), ("right", right.withColumn("pipeline_run_id", F.lit("other"))), ("same", left.repartition(3))):
        paths[name] = str(tmp_path / name)
        difference.write_tree(df, paths[name], ["k"])
    wanted = {(k, "lost", 1, 0) for k in range(3, 3000, 500)} | {(k, "changed", 1, 1) for k in range(5, 3000, 700)}
    wanted |= {(9, "changed", 1, 2), (10, "changed", 1, 2), (None, "added", 0, 1)}
    assert {tuple(r) for r in difference.row_differences(spark, paths["left"], paths["right"], ["k"]).collect()} == wanted
    assert difference.differing_prefixes(spark, paths["left"], paths["same"]).count() == 0
    assert difference.row_differences(spark, paths["left"], paths["same"], ["k"]).count() == 0
    # Leaves of other prefixes may be gone: they are not opened.
    tops = [r[0] for r in difference.differing_prefixes(spark, paths["left"], paths["right"]).select(F.substring("prefix", 1, 3)).distinct().collect()]
    leaves = spark.read.parquet(f"{paths['left']}/leaves")
    assert len(tops) <= 19 and leaves.filter(F.col("_top").isin(tops)).count() < 60
    leaves.filter(F.col("_top").isin(tops)).write.parquet(f"{tmp_path}/pruned/leaves")
    for width in (0, 3, 6, 9):
        spark.read.parquet(f"{paths['left']}/nodes/width={width}").write.parquet(f"{tmp_path}/pruned/nodes/width={width}")
    assert {tuple(r) for r in difference.row_differences(spark, f"{tmp_path}/pruned", paths["right"], ["k"]).collect()} == wanted


def test_lineage_with_circles_and_limits(spark):
    edges = [("kpi", "fact"), ("kpi", "excursion"), ("fact", "bronze"), ("excursion", "bronze"), ("excursion", "stream"), ("kpi", "bronze"),
             ("a", "b"), ("b", "c"), ("c", "a"), ("c", "file"), ("x", None), (None, "y"), ("a", "b"), ("loop", "loop")]
    pairs = lineage.closure(spark.createDataFrame(edges, "product STRING, source STRING"), "product", "source")
    found = {(r.product, r.ancestor): r.depth for r in pairs.collect()}
    wanted = {}
    for start in {p for p, s in edges if p and s}:
        reached, front, depth = {}, {start}, 0
        while front:
            depth += 1
            front = {s for p, s in edges if p in front and s} - reached.keys()
            reached |= {s: depth for s in front}
        wanted |= {(start, s): d for s, d in reached.items()}
    assert found == wanted
    facts = {r.product: tuple(r)[1:] for r in lineage.sources_of(pairs).collect()}
    assert facts["kpi"] == (4, 2, 2, False) and facts["a"] == (4, 1, 3, True) and facts["loop"] == (1, 0, 1, True)
    empty = lineage.closure(spark.createDataFrame([], "product STRING, source STRING"), "product", "source")
    assert empty.count() == 0
    with pytest.raises(GateFailed):
        lineage.closure(spark.createDataFrame(edges, "product STRING, source STRING"), "product", "source", most_depth=2)


def test_states_merge_to_the_same_kpis(spark):
    numbers = random.Random(3)
    rows = [(f"d{numbers.randrange(6)}", numbers.choice("AB"), numbers.choice([None, *range(1, 200_000, 997)]), numbers.choice([True, False, None]),
             numbers.choice([None, numbers.random() * 100])) for _ in range(4000)]
    facts = spark.createDataFrame(rows, "day STRING, site STRING, batch LONG, ok BOOLEAN, t DOUBLE")
    state = rollups.daily_state(facts, ["day", "site"], F.col("batch"), F.col("ok"), F.col("t"))
    for grain in (["day", "site"], ["site"], []):
        for s in (state, rollups.merged(state, ["site"])) if "day" not in grain else (state,):
            for r in rollups.read_kpis(s, grain).collect():
                own = [x for x in rows if all(getattr(r, g) == x[("day", "site").index(g)] for g in grain)]
                judged, measured = [x[3] for x in own if x[3] is not None], sorted(x[4] for x in own if x[4] is not None)
                assert (r.entities, r.records) == (len({x[2] for x in own if x[2] is not None}), len(own))
                assert r.pass_rate == pytest.approx(sum(judged) / len(judged))
                rank = sum(v <= r.quantile for v in measured) / len(measured)
                assert abs(rank - 0.95) <= rollups.RANK_ERROR + 1 / len(measured)
    bare = facts.limit(5).withColumns({"batch": F.lit(None).cast("long"), "ok": F.lit(None).cast("boolean"), "t": F.lit(None).cast("double")})
    row = rollups.read_kpis(rollups.daily_state(bare, ["site"], F.col("batch"), F.col("ok"), F.col("t")), []).first()
    assert tuple(row) == (0, 5, None, None)
    assert rollups.read_kpis(state.limit(0), ["site"]).count() == 0


def test_many_terms_in_pieces_of_long_texts(spark):
    numbers = random.Random(2)
    texts = ["".join(numbers.choice("abcAé \n") for _ in range(numbers.randrange(400))) for _ in range(60)] + ["", None, "abc", "ABCABC" * 300]
    terms = ["".join(numbers.choice("abcAé \n") for _ in range(numbers.choice([1, 2, 3, 4, 5, 7, 30]))) for _ in range(150)] + ["", None, "cabc" * 40, "zzz", "abc"]
    docs = spark.createDataFrame(list(enumerate(texts)), "id INT, text STRING")
    listed = spark.createDataFrame([(t,) for t in terms], "term STRING")
    wanted = {(i, t.lower()) for i, text in enumerate(texts) for t in terms if t and text and t.lower() in text.lower()}
    for piece in (37, documents.PIECE):
        found = [tuple(r) for r in documents.term_matches(docs, "id", "text", listed, "term", piece=piece).collect()]
        assert len(found) == len(set(found)) and set(found) == wanted
    assert documents.term_matches(docs, "id", "text", listed.limit(0), "term").count() == 0
    assert documents.term_matches(docs.limit(0), "id", "text", listed, "term").count() == 0


def test_lines_that_do_not_fit_are_kept(spark, tmp_path):
    lines = ['{"a":1,"b":"x"}', '{"a":"one","b":"y"}', "not json", '{"a":2', "[1]", '{"b":"z","more":1}', '"text"', "7"]
    (tmp_path / "l.json").write_text("\n".join(lines) + "\n")
    found = files.scan_json_lines(spark, str(tmp_path / "l.json"), contract("a BIGINT, b STRING"))
    rows = {(r.a, r.b, r.line_reason, r.raw_line) for r in found.collect()}
    assert rows == {(1, "x", None, None), (None, "y", files.WRONG_TYPE, lines[1]), (None, "z", None, None)} | {
        (None, None, files.NO_OBJECT, line) for line in (lines[2], lines[3], lines[4], lines[6], lines[7])
    }
    assert found.filter("line_reason IS NOT NULL").count() == 6


def test_heavy_join_equals_the_other_plans(spark):
    with comparison.settings(spark, {"spark.sql.adaptive.enabled": "false"}):
        facts = spark.range(5000).selectExpr("id % 2 AS a", "CASE WHEN id % 5 < 4 THEN 0 ELSE id END AS b", "id AS v")
        dimension = facts.select("a", "b").distinct().withColumn("w", F.col("b") + 1)
        joined = joins.heavy_hitter_join(facts, dimension, ["a", "b"], F.col("v"), salts=3, max_rows=1)
        assert joined.exceptAll(facts.join(dimension, ["a", "b"])).count() == 0 and joined.count() == 5000


def test_many_terms_are_never_broadcast(spark, tmp_path):
    # 300,000 names in a file far below Spark's broadcast threshold, against texts with some of them; the file is read as it is.
    spark.range(300_000).selectExpr("concat('Name#', lpad(id, 9, '0')) AS term").write.parquet(f"{tmp_path}/terms")
    terms = spark.read.parquet(f"{tmp_path}/terms")
    docs = spark.createDataFrame([(1, "x name#000000017 name#00000001"), (2, "NAME#000299999name#000300000"), (3, "💥name#000123456💥"), (4, "000123456")], "id INT, text STRING")
    found = documents.term_matches(docs, "id", "text", terms, "term")
    assert sorted(map(tuple, found.collect())) == [(1, "name#000000017"), (2, "name#000299999"), (3, "name#000123456")]
    assert joins.broadcast_if_small(terms)._jdf.queryExecution().logical().toString().lower().count("merge") == 1
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin [term" not in plan
    # The same whatever is broadcast at a time.
    assert sorted(map(tuple, documents.term_matches(docs, "id", "text", terms, "term", most=30_000).collect())) == sorted(map(tuple, found.collect()))


def test_a_tree_stores_few_bytes_a_row(spark, tmp_path):
    # Digests as bytes, and nodes as sums, not text of 64 digits at every level.
    difference.write_tree(spark.range(50_000).selectExpr("id AS k", "id % 7 AS v"), f"{tmp_path}/tree", ["k"])
    assert sum(f.stat().st_size for f in tmp_path.rglob("*.parquet") if f.is_file()) < 50_000 * 130


def test_lineage_looks_back_seldom(spark, tmp_path, monkeypatch):
    # Each look back reads all pairs so far, and once in a while is enough; a circle behind it ends too.
    kind = type(spark.range(1))
    looks, join = [], kind.join
    monkeypatch.setattr(kind, "join", lambda self, other, on=None, how=None: looks.append(how) or join(self, other, on, how))
    edges = spark.createDataFrame([(i, i // 2) for i in range(1, 300)] + [(i, i // 3) for i in range(1, 300)], "p LONG, s LONG")
    pairs = lineage.closure(edges, "p", "s")
    wanted = {}
    for p in range(1, 300):
        front, depth = {p}, 0
        while front := {s for x in front if x for s in (x // 2, x // 3)}:
            depth += 1
            wanted |= {(p, s): depth for s in front if (p, s) not in wanted}
    rows = [tuple(r) for r in pairs.collect()]
    assert len(rows) == len(wanted) and {(p, a): d for p, a, d in rows} == wanted
    assert 0 < looks.count("left_anti") < max(wanted.values()) - 1
    circle = spark.createDataFrame([(i, (i + 1) % 12) for i in range(12)], "p LONG, s LONG")
    found = {(r[0], r[1]): r[2] for r in lineage.closure(circle, "p", "s").collect()}
    assert found == {(i, (i + d) % 12): d for i in range(12) for d in range(1, 13)}
    assert lineage.closure(circle, "p", "s", most_depth=13).count() == 144
