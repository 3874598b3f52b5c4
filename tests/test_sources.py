import json

import pytest
from pyspark.sql import functions as F

from tidemark.operators.contracts import GateFailed
from tidemark.operators.hotkeys import HotKeys
from tidemark.schemas import QUALITY_SOURCE, TELEMETRY_SOURCE
from tidemark.sources import files, fixtures, messages, tables
from tidemark.streaming import bronze


def lines(path, count, start=0, **fields):
    path.write_text("".join(json.dumps({"event_id": f"E{i:03d}", **fields}) + "\n" for i in range(start, start + count)))
    return str(path)


def test_wrong_typed_field_becomes_null_and_the_row_survives(spark, tmp_path):
    path = tmp_path / "q.jsonl"
    path.write_text('{"observation_id":"O1","result_value":{"a":1},"schema_version":"99"}\nnot json\n')
    rows = files.read_json_lines(spark, str(path), QUALITY_SOURCE).orderBy("observation_id").collect()
    assert [r.observation_id for r in rows] == [None, "O1"]
    assert rows[1].result_value is None and rows[1].schema_version == "99" and rows[1].source_file.endswith("q.jsonl")


def test_landing_copy_and_reconciliation(spark, tmp_path):
    paths = [lines(tmp_path / f"part{i}.jsonl", 5 + i) for i in range(3)]
    landing = str(tmp_path / "landing")
    (tmp_path / "other").mkdir()
    paths.append(lines(tmp_path / "other" / "part0.jsonl", 9))
    landed = files.land_files(spark, paths, landing)
    copied = {"/" + r.source_file.removeprefix("file:").lstrip("/"): (r.rows_read, r.rows_copied, r.status) for r in landed.collect()}
    assert copied == {path: (n, n, "Succeeded") for path, n in zip(paths, (5, 6, 7, 9), strict=True)}
    paths.pop()
    scanned = spark.read.text(paths)
    assert files.verify_landing(scanned, 3, 18)["rows"] == 18
    with pytest.raises(GateFailed, match="3 files and 18 rows"):
        files.verify_landing(scanned, 3, 19)


def test_manifest_has_one_formula_for_all_sizes(spark, tmp_path):
    import hashlib

    root, other = tmp_path / "data", tmp_path / "else where"
    (root / "a").mkdir(parents=True)
    (other / "a").mkdir(parents=True)
    for place in (root, other):
        lines(place / "a" / "one.jsonl", 3)
        lines(place / "two.jsonl", 200)
        (place / "none.jsonl").write_text("")
        (place / "a" / "none.jsonl").write_text("")
        (place / "a" / "_none.jsonl").write_text("")
        (place / "_hidden").mkdir()
        (place / "_hidden" / "none.jsonl").write_text("")
        (place / "other.txt").write_text("")

    def manifest(place):
        found = files.file_manifest(spark, str(place), "*.jsonl", block_bytes=1000)
        return files.relative_manifest(found, str(place))

    rows = {r.path: r for r in manifest(root).collect()}
    for path, row in rows.items():
        content = (root / path).read_bytes()
        blocks = [content[i : i + 1000] for i in range(0, len(content), 1000)]
        written = "\n".join(hashlib.sha256(b).hexdigest() for b in blocks)
        assert (row.bytes, row.blocks_sha256) == (len(content), hashlib.sha256(written.encode()).hexdigest())
    assert set(rows) == {"a/one.jsonl", "two.jsonl", "none.jsonl", "a/none.jsonl"} and rows["two.jsonl"].bytes > 3000
    # Equal files in two folders do not differ, at any size; reordered lines do.
    assert files.manifest_differences(manifest(root), manifest(other)).count() == 0
    assert files.dataset_digest(manifest(root), str(root)).first() == files.dataset_digest(manifest(other), str(other)).first()
    text = (other / "two.jsonl").read_text().splitlines(keepends=True)
    (other / "two.jsonl").write_text("".join(reversed(text)))
    lines(other / "three.jsonl", 1)
    # A lost empty file and an emptied file are differences.
    (other / "a" / "none.jsonl").unlink()
    (other / "a" / "one.jsonl").write_text("")
    changed = files.manifest_differences(manifest(root), manifest(other)).orderBy("path").collect()
    assert [(r.path, r.expected_digest is None, r.found_digest is None) for r in changed] == [
        ("a/none.jsonl", False, True), ("a/one.jsonl", False, False), ("three.jsonl", True, False), ("two.jsonl", False, False),
    ]


def test_replay_emits_exactly_the_first_messages_in_order(spark, tmp_path):
    paths = [lines(tmp_path / "b.jsonl", 6, start=4), lines(tmp_path / "a.jsonl", 4)]
    target = str(tmp_path / "messages")
    receipt = messages.replay(messages.text_lines(spark, paths), 7, "topic", target).first()
    assert (receipt.events_attempted, receipt.events_emitted, receipt.connection_material_included) == (7, 7, False)
    sent = spark.read.parquet(target).orderBy("offset", "partition").collect()
    assert [json.loads(r.value)["event_id"] for r in sent] == [f"E{i:03d}" for i in range(7)]


@pytest.mark.parametrize("limit", [1, 3_000, 7_450, 9_000])
def test_replay_cuts_large_blocks_and_counts_on(spark, limit):
    """A day with most of the lines is ranked in many ranges; ordinals are those of one global sort."""
    rows = spark.range(9_000).select(
        F.when(F.col("id") < 1000, 1).when(F.col("id") < 8000, 2).otherwise(3).alias("day"),
        (F.col("id") * F.col("id")).alias("line"), F.col("id").alias("nth"),
    ).repartition(7, "nth")
    found = messages.first_messages(rows, limit, ["day"], "line", HotKeys(rows=2_000, slice_rows=200))
    assert found.columns == ["day", "line", "nth", "ordinal"]
    assert sorted((r.nth, r.ordinal) for r in found.collect()) == [(i, i) for i in range(limit)]


def test_jobs_name_brokers_topic_and_rate(spark, tmp_path, monkeypatch):
    from tidemark.plans import jobs, lakehouse

    asked = []
    monkeypatch.setattr(messages, "kafka_stream", lambda spark, *given: asked.append(given) or "stream")
    monkeypatch.setattr(lakehouse, "bronze_stream", lambda run, stream, origin: asked.append((stream, origin)))
    (tmp_path / "jaas").write_text("login required;\n")
    jobs.main(["bronze-stream", "--servers", "b1:9093", "--topic", "t", "--rate", "70", "--jaas-file", str(tmp_path / "jaas")])
    assert asked == [("b1:9093", "t", "login required;", 70), ("stream", "eventhubs://t")]
    jobs.main(["bronze-stream", "--servers", "b1:9093"])
    assert asked[2] == ("b1:9093", "quality-telemetry", None, messages.MESSAGES_PER_TRIGGER)


def test_replay_refuses_too_few_or_malformed_messages(spark, tmp_path):
    source = messages.text_lines(spark, lines(tmp_path / "a.jsonl", 4))
    with pytest.raises(GateFailed, match="4 messages but 5"):
        messages.replay(source, 5, "topic", str(tmp_path / "m"))
    (tmp_path / "bad.jsonl").write_text('{"event_id": null}\n[1]\n')
    with pytest.raises(GateFailed, match="1 lines are not"):
        messages.replay(messages.text_lines(spark, str(tmp_path / "bad.jsonl")), 2, "topic", str(tmp_path / "m"))
    with pytest.raises(ValueError):
        messages.replay(source, 0, "topic", str(tmp_path / "m"))


def test_stream_bronze_keeps_malformed_and_late_messages_and_restarts(spark, tmp_path):
    payloads = [
        '{"event_id":"E1","value":5.0,"event_ts":"2026-07-02T00:00:00Z"}',
        "not json",
        '{"event_id":"E2","value":{"x":1},"event_ts":"2026-07-01T00:00:00Z"}',
    ]
    log = spark.createDataFrame(list(enumerate(payloads)), "ordinal BIGINT, value STRING")
    folder = str(tmp_path / "messages")
    messages.as_messages(log, "topic", partitions=1).write.parquet(folder)

    def consume():
        stream = bronze.bronze_messages(messages.message_file_stream(spark, folder), "r1", "eventhubs://topic", TELEMETRY_SOURCE)
        return bronze.append_to_path(stream, str(tmp_path / "bronze"), str(tmp_path / "checkpoint"))

    consume()
    consume()
    rows = spark.read.parquet(str(tmp_path / "bronze")).orderBy("offset").collect()
    assert [r.event_id for r in rows] == ["E1", None, "E2"]
    assert [r.raw_payload for r in rows] == payloads
    assert rows[2].value is None and rows[0].source_file == "eventhubs://topic/partition-0"


def test_progress_is_a_table_that_repeats_replace(spark, tmp_path):
    log = spark.range(700).selectExpr("id AS ordinal", "concat('{\"event_id\":', id, '}') AS value")
    folder, places = str(tmp_path / "messages"), [str(tmp_path / n) for n in ("bronze", "progress", "checkpoint")]
    messages.as_messages(log, "topic", partitions=3).repartitionByRange(7, "offset").write.parquet(folder)
    latest = messages.latest_offsets(spark, folder)
    bronze.append_with_progress(messages.message_file_stream(spark, folder), *places, "r1", latest)
    progress = bronze.read_progress(spark, places[1])
    assert progress.count() == 21 and progress.agg(F.sum("input_rows")).first()[0] == 700
    ends = {r.partition: r.end for r in latest.selectExpr("partition", "latest_offset AS end").collect()}
    for r in progress.collect():
        assert r.lag == ends[r.partition] - r.end_offset and r.input_rows == r.end_offset - r.first_offset
    receipt = bronze.progress_receipt(progress).orderBy("batch_id").collect()
    assert [r.batch_id for r in receipt] == list(range(7)) and sum(r.input_rows for r in receipt) == 700
    assert set(json.loads(receipt[0].lags)) == {"0", "1", "2"}
    # The same micro-batches once more, as after a loss of the checkpoint.
    bronze.append_with_progress(messages.message_file_stream(spark, folder), *places[:2], str(tmp_path / "again"), "r1", latest)
    assert bronze.read_progress(spark, places[1]).count() == 21
    assert spark.read.parquet(places[0]).count() == 700


def test_table_read_as_stream(spark, tmp_path):
    spark.sql("CREATE SCHEMA IF NOT EXISTS streamed")
    tables.publish(spark.range(5), "streamed.numbers")
    stream = tables.read_table_as_stream(spark, "streamed.numbers")
    bronze.append_to_path(stream, str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 5


def test_full_publication_replaces_partitions_and_schema(spark):
    spark.sql("CREATE SCHEMA IF NOT EXISTS published")
    first = spark.range(10).selectExpr("id", "id % 3 AS part")
    tables.publish(first, "published.t", partition_by=("part",))
    tables.publish(first.filter("part = 1").selectExpr("id", "'x' AS more", "part"), "published.t", partition_by=("part",))
    found = spark.table("published.t")
    assert set(found.columns) == {"id", "more", "part"} and found.count() == 3


def test_fixture_defects_and_determinism(spark):
    size = fixtures.FixtureSize(quality=40, telemetry=40, messages=20, batches=10, quality_files=3)
    first, second = fixtures.quality(spark, size), fixtures.quality(spark, size)
    assert first.exceptAll(second).count() == 0
    rows = {r.row: r for r in first.collect()}
    assert rows[0].observation_id is None and rows[1].batch_id == "BATCH-UNKNOWN" and rows[3].sample_temperature_c == 145.0
    assert rows[2].event_timestamp == "2026-99-77T25:61:00Z" and rows[4].unit == "degF" and rows[5].analyst_shift == "night"
    assert rows[39].asDict() | {"row": 6} == rows[6].asDict()
    readings = {r.row: r for r in fixtures.telemetry(spark, size).collect()}
    assert readings[7].asDict() | {"row": 6} == readings[6].asDict() and len(readings) == 40
    assert readings[8].event_id == "EVT-00000008"


@pytest.mark.parametrize("bad", [{"batches": 1}, {"quality": 7}, {"telemetry": 5}, {"quality_files": 31_000}, {"sites": 0}])
def test_fixture_configuration_is_checked(bad):
    with pytest.raises(ValueError):
        fixtures.FixtureSize(**bad)
