import math
import random
from decimal import ROUND_HALF_EVEN, Decimal, localcontext
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from tidemark.functions import amounts
from tidemark.functions.text import redact
from tidemark.operators import comparison, content, contracts, documents, gold, ledger
from tidemark.operators.hotkeys import HotKeys, name_rows
from tidemark.operators.joins import broadcast_if_small
from tidemark.operators.selection import nearest_rank, quantile_cuts
from tidemark.sources import fixtures


def test_digest_ignores_order_and_partitions_but_not_rows(spark):
    df = spark.range(5000).selectExpr("id % 1700 AS a", "cast(id % 3 AS string) AS b")
    base = content.content_digest(df).first()
    assert content.content_digest(df.repartition(7).orderBy(F.desc("a"))).first() == base
    assert content.content_digest(df.limit(4999)).first() != base
    assert base.row_count == 5000
    stamped = df.withColumn("pipeline_run_id", F.uuid() if hasattr(F, "uuid") else F.expr("uuid()"))
    assert content.content_digest(stamped).first() == base


def test_digest_of_copies_and_of_nothing(spark):
    copies = spark.range(1000).selectExpr("1 AS a")
    assert content.content_digest(copies).first() != content.content_digest(copies.limit(999)).first()
    assert content.content_digest(copies.limit(0)).first().row_count == 0
    assert content.fingerprint(copies.limit(0)).first().row_count == 0


def test_fingerprint_by_group(spark):
    df = spark.range(100).selectExpr("id % 2 AS g", "id % 10 AS v")
    found = content.fingerprint(df.select("g", "v"), by=["g"]).collect()
    assert sorted(r.row_count for r in found) == [50, 50] and len({r.fingerprint for r in found}) == 2


def test_gate_names_failed_checks(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "k INT")
    checks = contracts.check_no_rows("unique_k", contracts.grain_violations(df, ["k"])).unionByName(
        contracts.check_rows_positive("has_rows", df)
    )
    with pytest.raises(contracts.GateFailed, match=r"\['unique_k'\]"):
        contracts.enforce(checks)
    contracts.enforce(checks.filter("check_name = 'has_rows'"))


def test_preflight_lists_missing_layers(spark):
    spark.sql("CREATE SCHEMA IF NOT EXISTS bronze")
    contracts.preflight(spark, ["bronze"])
    with pytest.raises(contracts.GateFailed, match="nowhere"):
        contracts.preflight(spark, ["bronze", "nowhere"])


def test_lineage_edges(spark):
    edges = {tuple(r) for r in contracts.lineage(spark).collect()}
    assert ("kpi_quality_summary", "gold.fact_batch_quality") in edges and len(edges) == 8


def artifact(**changes):
    row = dict.fromkeys(contracts.ARTIFACT_FIELDS, "x") | {"status": "VERIFIED"}
    return row | changes


def test_registry_rules(spark):
    rows = [
        artifact(artifact_id="ok"),
        artifact(artifact_id="blank", receipt="  "),
        artifact(artifact_id="plan", status="PRODUCTION_BLUEPRINT", limitation=""),
        artifact(artifact_id="bad", status="DONE"),
        artifact(artifact_id="twice", status="DEMONSTRATED"),
        artifact(artifact_id="twice", status="DEMONSTRATED"),
    ]
    document = spark.createDataFrame([(rows,)], "artifacts ARRAY<STRUCT<" + ", ".join(f"{f}: STRING" for f in contracts.ARTIFACT_FIELDS) + ">>")
    found = {tuple(r) for r in contracts.registry_violations(contracts.registry_from_document(document)).collect()}
    assert found == {
        ("blank", "VERIFIED requires receipt"), ("plan", "PRODUCTION_BLUEPRINT requires limitation"),
        ("bad", "invalid status"), ("twice", "duplicate artifact_id"),
    }
    lacking = contracts.registry_from_document(document).drop("notes")
    assert contracts.registry_violations(lacking).filter("rule = 'missing field notes'").count() == 6


def test_sequences_must_be_complete(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), ("b", 3), ("c", 1), ("c", 1), ("d", 0)], "g STRING, s INT")
    assert sorted(r.g for r in contracts.broken_sequences(df, ["g"], "s").collect()) == ["b", "c", "d"]


@pytest.mark.parametrize("budget", [None, "", "zero", "0", "-5", "NaN", "Infinity"])
def test_invalid_budgets_stop(spark, budget):
    row = ledger.cost_gate(spark.createDataFrame([(budget, "1")], "b STRING, c STRING"), "b", "c").first()
    assert (row.reason, row.action, row.allowed, row.cost_amount) == ("INVALID_BUDGET", "STOP", False, None)


def test_cost_thresholds_and_default(spark):
    costs = ["9.99", "10", "14.99", "15", "19.99", "20", "20.01", "-1", "x", "10.005", "10.015"]
    rated = ledger.cost_gate(spark.createDataFrame([(None, c) for c in costs], "b STRING, c STRING"), "b", "c", allow_default=True)
    found = {r.c: (r.reason, r.allowed) for r in rated.collect()}
    assert found == {
        "9.99": ("WITHIN_TARGET", True), "10": ("TARGET_REACHED", True), "14.99": ("ABOVE_TARGET", True),
        "15": ("RETRY_STOP", False), "19.99": ("RETRY_STOP", False), "20": ("BUDGET_REACHED", False),
        "20.01": ("BUDGET_EXCEEDED", False), "-1": ("INVALID_CURRENT_COST", False), "x": ("INVALID_CURRENT_COST", False),
        "10.005": ("TARGET_REACHED", True), "10.015": ("ABOVE_TARGET", True),
    }


def test_copy_totals_from_receipt(spark):
    receipt = spark.createDataFrame(
        [([(5, 5, 10), (7, 6, 20)],)], "copy_activities ARRAY<STRUCT<rows_read: INT, rows_copied: INT, bytes_written: INT>>"
    )
    row = ledger.copy_totals(ledger.activities_of(receipt)).first()
    assert (row.activities, row.rows_read, row.rows_copied, row.bytes_written, row.reconciled) == (2, 12, 11, 30, False)


def test_redaction(spark):
    text = (
        "mail Some.One@Example.org id 123E4567-e89b-12d3-a456-426614174000 "
        "Endpoint=sb://x;SharedAccessKeyName=n;SharedAccessKey=k url?SIG=abc&x=1"
    )
    found = spark.createDataFrame([(text,)], "t STRING").select(redact(F.col("t"))).first()[0]
    assert found == "mail <redacted-email> id <redacted-guid> <redacted-event-hubs-connection> url?SIG=<redacted>&x=1"


def test_terms_alerts_and_search(spark):
    docs = spark.createDataFrame([(1, "Alpha and BETA"), (2, "none"), (3, None)], "id INT, t STRING")
    assert sorted(tuple(r) for r in documents.term_hits(docs, "id", "t", ["beta", "alpha", "Alpha"]).collect()) == [
        (1, "alpha"), (1, "beta"),
    ]
    log = spark.createDataFrame([("Administrative", "Failed"), ("Administrative", "Ok"), (None, "Failed")], "category STRING, status STRING")
    assert documents.alerts(log, documents.FAILED_ADMINISTRATION).count() == 1
    assert documents.search(docs.withColumn("s", F.lit("X")), "s", "ALL", ["t"], " beta ").count() == 1
    assert documents.search(docs.withColumn("s", F.lit("X")), "s", "Y", ["t"], "").count() == 0


# --- gold edges -------------------------------------------------------------------------------


def at(minute, second=0):
    return f"2026-07-01 00:{minute:02d}:{second:02d}"


def test_excursion_windows(spark):
    readings = spark.createDataFrame(
        [
            ("E1", "T1", "B1", "S1", "temperature_c", 9.0, at(1)),
            ("E2", "T1", "B1", "S1", "temperature_c", 11.0, at(13, 30)),
            ("E3", "T1", "B1", "S1", "temperature_c", 10.0, at(16)),  # next window
            ("E4", "T1", "B1", "S1", "temperature_c", 8.0, at(2)),  # exactly at the limit
            ("E5", "T1", "B2", "S1", "temperature_c", 99.0, at(1)),  # product without a limit
            ("E6", "T1", "B9", "S1", "temperature_c", 99.0, at(1)),  # unknown batch
            ("E7", "T1", "B1", "S1", "vibration_mm_s", 99.0, at(1)),
            ("E8", "T2", "B1", None, "temperature_c", 9.0, at(1)),  # site from the batch
        ],
        "event_id STRING, sensor_id STRING, batch_id STRING, site_id STRING, metric_name STRING, value DOUBLE, t STRING",
    ).withColumn("event_timestamp_utc", F.to_timestamp("t"))
    batches = spark.createDataFrame([("B1", "P1", "S1"), ("B2", "P2", "S1")], "batch_id STRING, product_id STRING, site_id STRING")
    products = spark.createDataFrame([("P1", 8.0)], "product_id STRING, temperature_limit_c DOUBLE")
    found = gold.excursion_fact(readings, batches, products).orderBy("sensor_id", "excursion_start_utc").collect()
    assert [(r.sensor_id, r.site_id, r.event_count, r.maximum_temperature_c, r.excursion_duration_minutes) for r in found] == [
        ("T1", "S1", 2, 11.0, 12.5), ("T1", "S1", 1, 10.0, 0.0), ("T2", "S1", 1, 9.0, 0.0),
    ]
    import hashlib

    assert found[0].excursion_id == hashlib.sha256(b"B1|T1|2026-07-01 00:00:00").hexdigest()


def test_kpi_spine_and_defaults(spark):
    facts = spark.createDataFrame(
        [("O1", "B1", "S1", "P1", 1.0, 0.0, 2.0), ("O2", "B1", "S1", "P1", 3.0, 0.0, 2.0), ("O3", "B2", None, "P1", None, 0.0, 2.0)],
        "observation_id STRING, batch_id STRING, site_id STRING, product_id STRING, result_value DOUBLE, spec_lower DOUBLE, spec_upper DOUBLE",
    ).withColumns({"test_type": F.lit("assay"), "event_timestamp_utc": F.to_timestamp(F.lit("2026-07-01 05:00:00"))})
    quarantined = spark.createDataFrame(
        [("S1", "P1", "2026-07-01T00:00:00Z"), ("S1", "P1", "2026-99-77T25:61:00Z"), ("S1", "P1", "2026-07-02T00:00:00Z"), (None, "P1", "2026-07-01T00:00:00Z")],
        "site_id STRING, product_id STRING, event_timestamp_utc STRING",
    )
    excursions = spark.createDataFrame(
        [("B1", "S1", "P1", 10.0, 9.0), ("B7", "S1", "P1", 20.0, 30.0), ("B8", "S9", "P1", 1.0, 1.0)],
        "batch_id STRING, site_id STRING, product_id STRING, excursion_duration_minutes DOUBLE, maximum_temperature_c DOUBLE",
    ).withColumn("excursion_start_utc", F.to_timestamp(F.lit("2026-07-01 05:00:00")))
    rows = {r.site_id: r for r in gold.daily_kpis(gold.batch_quality_fact(facts), quarantined, excursions).collect()}
    main, nulls = rows["S1"], rows[None]
    assert len(rows) == 2
    assert (main.batches_processed, main.records_quarantined, main.batches_with_excursions) == (1, 1, 2)
    assert (main.quality_pass_rate, main.excursion_rate, main.p95_temperature_c) == (0.5, 2.0, 30.0)
    assert main.invalid_record_rate == pytest.approx(1 / 3) and main.mean_excursion_duration_minutes == 15.0
    # A NULL key joins nothing, and a missing result has no pass rate.
    assert (nulls.records_quarantined, nulls.batches_with_excursions, nulls.quality_pass_rate) == (0, 0, None)


# --- skewed join ------------------------------------------------------------------------------


def test_skewed_plans_agree_and_settings_return(spark):
    rows, dimension = 20_000, 25
    facts, lines = fixtures.skewed_facts(spark, rows, dimension, 8), fixtures.product_lines(spark, dimension)
    assert facts.filter("join_key = 0").count() >= 0.8 * rows
    before = spark.conf.get("spark.sql.adaptive.enabled")
    names = comparison.skewed_join_plans(facts, lines).keys()
    plans = {n: (lambda n=n: comparison.skewed_join_plans(facts, lines, salts=8, partitions=8)[n]) for n in names}
    result = comparison.compare_plans(spark, plans, "shuffle_hash")
    assert result["results_match"] and all(len(r) == 3 for r in result["runs"].values())
    assert result["join_strategy"]["broadcast"] == "BROADCAST" and result["join_strategy"]["shuffle_hash"] == "SHUFFLE"
    assert spark.conf.get("spark.sql.adaptive.enabled") == before
    with pytest.raises(ValueError):
        comparison.compare_plans(spark, plans, "shuffle_hash", iterations=2)
    with pytest.raises(ValueError):
        fixtures.skewed_facts(spark, 0)


def test_broadcast_only_below_the_limit(spark):
    def hinted(df):
        joined = spark.range(10).join(df, "id")
        return "BroadcastHashJoin" in joined._jdf.queryExecution().executedPlan().toString()

    with comparison.settings(spark, comparison.STATIC_PLANS):
        assert hinted(broadcast_if_small(spark.range(100), max_rows=100))
        assert not hinted(broadcast_if_small(spark.range(101), max_rows=100))


def test_duration_statistics(spark):
    df = spark.createDataFrame([("a", v) for v in [1, 2, 3, 4, 5]], "m STRING, d INT")
    assert tuple(comparison.duration_statistics(df, "m", "d").first()) == ("a", 5, 4)
    assert tuple(comparison.run_medians(df, "m", "d").first()) == ("a", 3.0, 3)
    assert tuple(comparison.run_medians(df.filter("d < 5"), "m", "d").first()) == ("a", 2.5, 3)


@pytest.mark.parametrize(
    ("budget", "cost", "reason"),
    [("20", "1000000000000000000", "BUDGET_EXCEEDED"), ("20", "1e40", "BUDGET_EXCEEDED"), ("10000000000000000000", "3", "WITHIN_TARGET"),
     ("20", "-1e18", "INVALID_CURRENT_COST"), ("NaN", "1", "INVALID_BUDGET"), ("20", "Infinity", "INVALID_CURRENT_COST")],
)
def test_large_amounts_keep_their_meaning(spark, budget, cost, reason):
    row = ledger.cost_gate(spark.createDataFrame([(budget, cost)], "b STRING, c STRING"), "b", "c").first()
    assert row.reason == reason


def test_nearest_rank_is_exact_beyond_a_million_values(spark):
    values = spark.range(1_200_003).select(F.lit("g").alias("g"), (F.col("id") * 11 % 1_200_003).cast("double").alias("v"))
    assert nearest_rank(values, "g", "v", 0.75).first().v == -(-3 * 1_200_003 // 4) - 1


@pytest.mark.parametrize("quantile", [0.0, 0.1, 0.29, 0.5, 0.75, 1.0])
def test_nearest_rank_by_ranges_equals_sorting(spark, quantile):
    """Hot groups with equal values, lopsided values and NULLs; a small range size, so that few values are opened."""
    numbers = random.Random(6)
    rows = [("flat", 5.0)] * 400 + [("wide", float(10 ** numbers.randrange(9))) for _ in range(900)] + [(None, float(i)) for i in range(700)]
    rows += [("half", 1.0)] * 500 + [("half", numbers.random()) for _ in range(500)] + [("one", 3.0), ("none", None), ("none", float("nan"))]
    numbers.shuffle(rows)
    df = spark.createDataFrame(rows, "g STRING, v DOUBLE")
    wanted = {}
    for g in ("flat", "wide", None, "half", "one"):
        own = sorted(v for k, v in rows if k == g)
        wanted[g] = own[max(1, math.ceil(Fraction(str(quantile)) * len(own))) - 1]
    for hot in (HotKeys(), HotKeys(rows=300, slice_rows=50), HotKeys(rows=1, slice_rows=1)):
        assert {r.g: r.v for r in nearest_rank(df, "g", "v", quantile, hot).collect()} == wanted
    # A range holds about slice_rows different values.
    cuts = quantile_cuts(name_rows(df.filter("g IS NULL"), ["g"]), ["g"], ["v"], HotKeys(rows=1, slice_rows=50)).first()
    assert 9 <= len(cuts[1]) <= 20


def test_amounts_of_any_length_equal_decimal_arithmetic(spark):
    numbers = random.Random(9)
    texts = ["0", "-0", "-0.00", "1e35", "2e35", "1" * 60, "9" * 40 + ".995", "9" * 40 + ".985", "0.005", "0.015", "0.0050000000000000000000000001", ".5", "5.", "+7", " 12 ",
             "1e-30", "-1e-30", "10.01499999999999999999999", "99999999999999999.995", "1E+3", "-12.345e1", "0e9", "00012.50", "123e-2", "995e-3", "9995e-6", "4e-3"]
    for _ in range(300):
        digits = "".join(numbers.choice("0123456789955") for _ in range(numbers.randrange(1, 45)))
        at = numbers.randrange(len(digits) + 1)
        exponent = numbers.choice(["", "", f"e{numbers.randrange(-40, 41)}"])
        texts.append(numbers.choice(["", "-"]) + (f"{digits[:at]}.{digits[at:]}" if numbers.random() < 0.7 else digits) + exponent)
    bad = ["", " ", ".", "-", "e5", "1e", "NaN", "Infinity", "-inf", "1,5", "0x10", "1e99999", "twelve", "1" * 30 + "x", None]
    df = spark.createDataFrame([(t,) for t in texts + bad], "t STRING")
    found = df.select("t", amounts.sign(F.col("t")).alias("s"), amounts.money(F.col("t")).alias("m")).collect()
    with localcontext() as context:
        context.prec = 200
        for r in found[: len(texts)]:
            number = Decimal(r.t.strip())
            assert (r.s, r.m) == ((number > 0) - (number < 0), f"{abs(number).quantize(Decimal('0.01'), ROUND_HALF_EVEN):f}"), r
    assert [(r.s, r.m) for r in found[len(texts) :]] == [(None, None)] * len(bad)


def test_a_budget_of_35_zeros(spark):
    rows = [("1e35", "2e35"), ("1e35", "1" + "0" * 35), ("2e35", "1e35"), ("1e400", "1e399"), ("20", "15.004"), ("1" + "0" * 35, "100000000000000000000000000000000000.01")]
    rated = ledger.cost_gate(spark.createDataFrame(rows, "b STRING, c STRING"), "b", "c").collect()
    assert [r.reason for r in rated] == ["BUDGET_EXCEEDED", "BUDGET_REACHED", "RETRY_STOP", "RETRY_STOP", "RETRY_STOP", "BUDGET_EXCEEDED"]
    assert rated[0].budget_amount == "1" + "0" * 35 + ".00"
