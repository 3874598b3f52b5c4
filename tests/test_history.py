import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import history
from tidemark.operators.hotkeys import HotKeys
from tidemark.operators.timeline import Timeline
from tidemark.schemas import BATCH_MASTER, CHANGE_EVENT
from tidemark.streaming.history import maintain_history, read_heads, read_history

LOG = "k STRING, s BIGINT, at STRING, status STRING, site STRING, note STRING, op STRING"
EVENTS = [
    ("A", 1, "t1", "REVIEW", "S1", "n1", "INSERT"),
    ("A", 3, "t0", "HOLD", "S1", "n3", "UPDATE"),  # sequence order against time order
    ("A", 2, "t9", "REVIEW", "S1", "n2", "UPDATE"),  # untracked change only
    ("A", 3, "t5", "RELEASED", "S1", "n4", "UPDATE"),  # equal sequence, later effective time
    ("B", 1, "t1", "REVIEW", "S2", "n1", "INSERT"),
    ("B", 2, "t2", "REVIEW", "S2", None, "DELETE"),
    ("B", 4, "t4", "REVIEW", "S2", "back", "INSERT"),  # same values after a delete
    ("B", 5, "t5", "REVIEW", "S2", "last", "UPDATE"),
    ("C", 1, "t1", "REVIEW", None, "n1", "INSERT"),
    ("C", 2, "t2", "REVIEW", "S3", "n2", "UPDATE"),  # NULL to a value is a change
    ("D", 1, "t1", "X", "S1", "n", "INSERT"),
    ("D", 2, "t2", "X", "S1", "n", "DELETE"),
]


ALL_HOT = HotKeys(rows=1)


def tracked(log, slice_by=None, hot=ALL_HOT):
    return history.history_tracked(
        log, ["k"], ["s", "at"], ["status", "site"], ["op"], F.col("op") == "DELETE", slice_by, hot
    )


EXPECTED = {
    ("A", "REVIEW", "S1", "n2", 1, "t1", 3, "t0", False),
    ("A", "HOLD", "S1", "n3", 3, "t0", 3, "t5", False),
    ("A", "RELEASED", "S1", "n4", 3, "t5", None, None, True),
    ("B", "REVIEW", "S2", "n1", 1, "t1", 2, "t2", False),
    ("B", "REVIEW", "S2", "last", 4, "t4", None, None, True),
    ("C", "REVIEW", None, "n1", 1, "t1", 2, "t2", False),
    ("C", "REVIEW", "S3", "n2", 2, "t2", None, None, True),
    ("D", "X", "S1", "n", 1, "t1", 2, "t2", False),
}


def rows(df):
    return {tuple(r) for r in df.select("k", "status", "site", "note", "start_s", "start_at", "end_s", "end_at", "is_current").collect()}


@pytest.mark.parametrize(("width", "hot"), [(1, ALL_HOT), (2, ALL_HOT), (1, HotKeys(rows=3)), (1, HotKeys())])
def test_tracked_history(spark, width, hot):
    log = spark.createDataFrame(EVENTS, LOG)
    assert rows(tracked(log, F.floor(F.col("s") / width), hot)) == EXPECTED


def test_tracked_history_does_not_depend_on_arrival_order_or_repeats(spark):
    log = spark.createDataFrame(EVENTS[::-1] + EVENTS[:4], LOG)
    assert rows(tracked(log)) == EXPECTED


def test_current_state_drops_deleted_keys(spark):
    log = spark.createDataFrame(EVENTS, LOG)
    current = history.current_state(log, ["k"], ["s", "at"], ["k", "status", "note"], F.col("op") == "DELETE")
    assert {tuple(r) for r in current.collect()} == {("A", "RELEASED", "n4"), ("B", "REVIEW", "last"), ("C", "REVIEW", "n2")}


def master(spark):
    rows = [
        ("B1", "S1", "P1", "L1", "2026-01-01T00:00:00Z", "REVIEW", "2026-01-01T00:00:00Z", 1, "1.0"),
        ("B2", "S2", "P2", "L2", "2026-01-01T00:00:00Z", "RELEASED", "2026-01-01T00:00:00Z", 1, "1.0"),
    ]
    return spark.createDataFrame(rows, BATCH_MASTER)


def change(key, batch, sequence, at, status):
    return (key, batch, "UPDATE", sequence, at, status, "erp", "1.0")


def test_full_history_orders_by_time(spark):
    changes = spark.createDataFrame(
        [
            change("C1", "B1", 3, "2026-03-01T00:00:00Z", "RELEASED"),
            change("C2", "B1", 2, "2026-02-01T00:00:00Z", "HOLD"),
            change("C3", "B9", 2, "2026-02-01T00:00:00Z", "HOLD"),
            change("C2", "B1", 2, "2026-02-01T00:00:00Z", "HOLD"),
        ],
        CHANGE_EVENT,
    )
    built = history.history_recomputed(master(spark), changes, hot=ALL_HOT)
    found = built.filter("batch_id = 'B1'").orderBy("effective_start_utc").collect()
    assert [r.release_status for r in found] == ["REVIEW", "HOLD", "RELEASED"]
    assert [r.effective_end_utc for r in found] == [r.effective_start_utc for r in found[1:]] + [None]
    assert [r.is_current_int for r in found] == [0, 0, 1]
    assert built.filter("is_current").count() == 2 and built.count() == 4


def test_timeline_equals_plain_windows_with_null_keys_and_hot_key(spark):
    df = spark.range(4000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 1 WHEN id % 7 = 0 THEN NULL ELSE id % 50 END AS k",
        "CASE WHEN id % 11 = 0 THEN NULL ELSE (id * 7919) % 4001 END AS o", "id AS n",
    )
    # Keys 0 to 49 have some 40 rows and stay whole, key 1 and NULL are cut.
    line = Timeline(("k",), ("o", "n"), F.floor(F.col("o") / 100), HotKeys(rows=200))
    placed = line.lay_out(df, ["n"])
    with_both = line.with_neighbour(placed, "before", ["n"], forward=False)
    with_both = line.with_neighbour(with_both, "after", ["n"], forward=True)
    got = line.restore(with_both).selectExpr("k", "o", "n", "before.n AS b", "after.n AS a")
    plain = spark.sql(
        """SELECT k, o, n, lag(n) OVER w AS b, lead(n) OVER w AS a
           FROM {df} WINDOW w AS (PARTITION BY k ORDER BY o, n)""",
        df=df,
    )
    assert got.exceptAll(plain).count() == 0 and got.count() == 4000


@pytest.mark.parametrize("spread", ["sparse", "burst", "lopsided", "one_first_value"])
def test_slices_follow_the_rows(spark, spread):
    """Numbers far apart, times within an hour, half of the rows at one end, one value in the first order column."""
    first = {
        "sparse": "id * 1000000", "burst": "CAST(3600 * (id / 20000) AS BIGINT)", "one_first_value": "7",
        "lopsided": "CASE WHEN id < 10000 THEN id ELSE id * 1000003 END",
    }[spread]
    df = spark.range(20_000).selectExpr("1 AS k", f"{first} AS o", "id AS n", "CAST(id % 5 AS STRING) AS v")
    df = df.unionByName(df.filter("n < 900")).unionByName(df.filter("n < 300").withColumn("k", F.lit(2)))
    line = Timeline(("k",), ("o", "n"), hot=HotKeys(rows=1000, slice_rows=500))
    placed = line.lay_out(df, ["v"])
    sizes = [r["count"] for r in placed.groupBy(*line.place).count().collect() if r._key_k == 1]
    assert sum(sizes) == 20_000 and 28 <= len(sizes) <= 55 and max(sizes) < 1500
    assert placed.filter("_key_k = 2").select("_slice").distinct().count() == 1
    got = line.restore(line.with_neighbour(line.with_neighbour(placed, "before", ["n"], False), "after", ["n"], True))
    plain = spark.sql("SELECT k, o, n, lag(n) OVER w AS b, lead(n) OVER w AS a FROM {df} WINDOW w AS (PARTITION BY k ORDER BY o, n)", df=df.distinct())
    assert got.selectExpr("k", "o", "n", "before.n AS b", "after.n AS a").exceptAll(plain).count() == 0


def test_cuts_hold_null_positions_and_few_rows(spark):
    df = spark.createDataFrame([(1, None, 1), (1, None, 2), (1, 5, None), (1, 5, 3), (None, 1, 1)], "k INT, o INT, n INT")
    for rows in (1, 2, 3, 10):
        line = Timeline(("k",), ("o", "n"), hot=HotKeys(rows=1, slice_rows=rows))
        got = line.restore(line.with_neighbour(line.lay_out(df, ["n"]), "after", ["o", "n"], True))
        assert {(r.k, r.o, r.n, r.after and tuple(r.after)) for r in got.collect()} == {
            (1, None, 1, (None, 2)), (1, None, 2, (5, None)), (1, 5, None, (5, 3)), (1, 5, 3, None), (None, 1, 1, None)
        }


def test_streamed_history_equals_batch_and_a_repeat_changes_nothing(spark, tmp_path):
    schema = spark.createDataFrame([], LOG).schema
    arrivals = str(tmp_path / "arrivals")
    for part in (EVENTS[6:], EVENTS[2:6], EVENTS[:2]):
        spark.createDataFrame(part, LOG).coalesce(1).write.mode("append").parquet(arrivals)

    def follow():
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(arrivals)
        return maintain_history(
            stream, ["k"], tracked, str(tmp_path / "log"), str(tmp_path / "history"), str(tmp_path / "checkpoint"), buckets=4
        )

    follow()
    assert rows(read_history(spark, str(tmp_path / "history"))) == EXPECTED
    follow()
    assert rows(read_history(spark, str(tmp_path / "history"))) == EXPECTED
    # A late delete of the only version of a new key empties nothing else.
    spark.createDataFrame([("A", 9, "t9", "RELEASED", "S1", "x", "DELETE")], LOG).coalesce(1).write.mode("append").parquet(arrivals)
    follow()
    closed = {r[:6] + (9, "t9", False) if r[0] == "A" and r[8] else r for r in EXPECTED}
    assert rows(read_history(spark, str(tmp_path / "history"))) == closed


def test_a_micro_batch_reads_its_own_keys_and_carries_the_others(spark, tmp_path):
    numbers = random.Random(11)
    events = [
        (numbers.choice([*"ABCDEFGH", None]), numbers.randrange(90), f"t{numbers.randrange(3)}", numbers.choice("XY"), "p", f"n{n:03d}",
         numbers.choice(["UPDATE"] * 5 + ["DELETE"]))
        for n in range(72)
    ]
    schema, arrivals, built = spark.createDataFrame([], LOG).schema, str(tmp_path / "arrivals"), []
    places = [str(tmp_path / name) for name in ("log", "history", "checkpoint")]

    def build(log):
        built.append({r.k for r in log.select("k").distinct().collect()})
        return tracked(log)

    def follow(part):
        spark.createDataFrame(part, LOG).coalesce(1).write.mode("append").parquet(arrivals)
        stream = spark.readStream.schema(schema).parquet(arrivals)
        maintain_history(stream, ["k"], build, *places, buckets=2, log_versions=3)

    for i in range(0, 72, 12):
        part = events[i : i + 12] if i < 36 else [e for e in events[i : i + 12] if e[0] in ("A", "B", None)]
        events[i : i + 12] = part + [part[0]] * (12 - len(part))
        follow(events[i : i + 12])
        assert built[-1] == {e[0] for e in events[i : i + 12]}
        heads = read_heads(spark, places[1])
        assert max(h.log_versions for h in heads.values()) <= 3
        assert rows(read_history(spark, places[1])) == brute_force(events[: i + 12])
    # Of each bucket's log only the versions from the last compaction on are read.
    live = [p for p in (tmp_path / "log").glob("key_bucket=*/arrival_batch=*") if int(p.name.split("=")[1]) >= heads[int(p.parent.name.split("=")[1])].log_from]
    assert len(live) <= 6 and len(list((tmp_path / "log").glob("key_bucket=*/arrival_batch=*"))) > 6


def test_a_broken_micro_batch_is_repeated_from_the_same_state(spark, tmp_path):
    schema, arrivals, broken = spark.createDataFrame([], LOG).schema, str(tmp_path / "arrivals"), []
    places = [str(tmp_path / name) for name in ("log", "history", "checkpoint")]

    def build(log):
        found = tracked(log)
        if broken:
            broken.clear()
            raise RuntimeError("executor lost")
        return found

    def follow():
        maintain_history(spark.readStream.schema(schema).parquet(arrivals), ["k"], build, *places, buckets=2, log_versions=2)

    for i, part in enumerate((EVENTS[6:], EVENTS[2:6], EVENTS[:2])):
        spark.createDataFrame(part, LOG).coalesce(1).write.mode("append").parquet(arrivals)
        before = rows(read_history(spark, places[1])) if i else None
        if i:
            broken.append(True)
            with pytest.raises(Exception, match="executor lost"):
                follow()
            assert rows(read_history(spark, places[1])) == before
        follow()
    assert rows(read_history(spark, places[1])) == EXPECTED


def test_a_third_of_all_events_being_copies_of_one(spark):
    events = spark.createDataFrame(EVENTS, LOG)
    copies = spark.range(2000).selectExpr(
        "'A' AS k", "3L AS s", "'t0' AS at", "'HOLD' AS status", "'S1' AS site", "'n3' AS note", "'UPDATE' AS op"
    )
    assert rows(tracked(events.unionByName(copies), F.col("s"), HotKeys(rows=1000))) == EXPECTED


def brute_force(events):
    """The tracked history by plain iteration over each key's sorted events."""
    latest = {}
    for k, s, at, status, site, note, op in events:
        content = (status, site, note, op == "DELETE")
        latest[k, s, at] = max(latest.get((k, s, at), content), content)
    found = set()
    for key in {k for k, _, _ in latest}:
        version = None
        for (_, s, at), (status, site, note, gone) in sorted(item for item in latest.items() if item[0][0] == key):
            if version and not gone and version[1:3] == (status, site):
                version = (*version[:3], note, *version[4:])
                continue
            if version:
                found.add((*version, s, at, False))
            version = None if gone else (key, status, site, note, s, at)
        if version:
            found.add((*version, None, None, True))
    return found


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_tracked_history_equals_brute_force_on_random_events(spark, seed):
    numbers = random.Random(seed)
    events = [
        (
            numbers.choice(["A", "A", "A", "B", "C", "D", "E"]), numbers.randrange(60), f"t{numbers.randrange(3)}",
            numbers.choice("XY"), numbers.choice("pq"), f"n{n:03d}", numbers.choice(["UPDATE"] * 5 + ["DELETE"]),
        )
        for n in range(250)
    ]
    log = spark.createDataFrame(events, LOG)
    expected = brute_force(events)
    assert rows(tracked(log, F.floor(F.col("s") / 7), HotKeys(rows=60))) == expected
    assert rows(tracked(log, hot=HotKeys(rows=30, slice_rows=8))) == expected
    assert rows(tracked(log, hot=HotKeys())) == expected


def test_only_the_last_version_is_current_with_unparsable_times(spark):
    master = spark.createDataFrame(
        [("B1", "S", "P", "L", "t", "REVIEW", "2024-01-01T00:00:00Z", 1, 1)],
        "batch_id STRING, site_id STRING, product_id STRING, lot_number STRING, manufactured_at STRING, "
        "release_status STRING, effective_at STRING, sequence_number BIGINT, schema_version INT",
    )
    changes = spark.createDataFrame(
        [("B1", "HOLD", "bad", 2, 1), ("B1", "RELEASED", "worse", 3, 1)],
        "batch_id STRING, release_status STRING, effective_at STRING, sequence_number BIGINT, schema_version INT",
    )
    found = history.history_recomputed(master, changes).collect()
    assert len(found) == 3 and [r.is_current for r in found].count(True) == 1


def test_ties_end_the_same_in_any_input_order(spark):
    events = [("A", 1, "t1", status, "S1", note, "INSERT") for status in ("HOLD", "RELEASED") for note in ("n1", "n2")]
    for _ in range(4):
        random.shuffle(events)
        log = spark.createDataFrame(events, LOG).withColumnRenamed("status", "release_status")
        current = history.current_state(log, ["k"], ["s", "at"], ["k", "release_status", "note"], F.col("op") == "DELETE")
        assert [tuple(r) for r in current.collect()] == [("A", "RELEASED", "n2")]
