"""The operators over the driver's Parquet tables, each next to the SQL that must agree with it.

Defects are injected by arithmetic on keys so that both engines see the same rows. Times stay
``timestamp_ntz``; money is summed as decimals and ratios are rounded before they are compared.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.columns import digest, joined_text
from tidemark.functions.rules import Expectation, differs, flagged, missing, outside, wrong_unit
from tidemark.operators import (
    comparison, content, contracts, difference, documents, expectations, gold, history, ledger, lineage, rollups,
)
from tidemark.operators.duplicates import mark_duplicates
from tidemark.operators.joins import aggregate_before_join, broadcast_if_small, heavy_hitter_join, salted_shuffle_hash_join
from tidemark.operators.provenance import change_log, stamp
from tidemark.operators.routing import (
    KNOWN, PARSED, REASON, REPEATED, Policy, Routed, quality_policy, quality_policy_basic, reason_counts, route,
    telemetry_policy_basic,
)
from tidemark.schemas import contract
from tidemark.session import workdir
from tidemark.sources import files, messages, tables
from tidemark.streaming import bronze
from tidemark.streaming.history import maintain_history, read_history

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name, with its SQL twin where there is one."""

    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table with the place of every row, the last tie-break of duplicate ranking."""
    scanned = table(spark, sf_dir, name)
    return scanned.select(
        "*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row")
    )


POSITION = ("_file", "_row")


def decimal_text(column: str, precision: str = "decimal(18,2)") -> Column:
    return F.col(column).cast(precision).cast("string")


# --- provenance -------------------------------------------------------------------------------


def _line_text() -> Column:
    amounts = [decimal_text(c) for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")]
    shipped = F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss")
    return joined_text(
        ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", *amounts, "l_returnflag", "l_linestatus", shipped]
    )


@query("""
SELECT l_orderkey, l_linenumber, 'lineitem' AS source_file, 'run-1' AS pipeline_run_id,
       strftime(l_shipdate, '%Y-%m-%d') AS event_timestamp_utc,
       sha256(concat_ws('|', l_orderkey, l_partkey, l_suppkey, l_linenumber,
         CAST(l_quantity AS DECIMAL(18,2)), CAST(l_extendedprice AS DECIMAL(18,2)), CAST(l_discount AS DECIMAL(18,2)),
         CAST(l_tax AS DECIMAL(18,2)), l_returnflag, l_linestatus, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S'))) AS record_hash
FROM lineitem
""")
def bronze_provenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").withColumn("ship_text", F.date_format("l_shipdate", "yyyy-MM-dd"))
    stamped = stamp(
        lines, source_file="lineitem", run_id="run-1", ingested_at="2026-01-01T00:00:00Z",
        raw_time="ship_text", hash_text=_line_text(),
    )
    return stamped.select(
        "l_orderkey", "l_linenumber", "source_file", "pipeline_run_id", "event_timestamp_utc", "record_hash"
    )


@query("""
SELECT 'BASE-' || c_custkey AS event_id, c_custkey AS batch_id, 'INSERT' AS operation, 0::BIGINT AS sequence_number,
       '1990-01-01' AS effective_at, c_mktsegment AS release_status, c_nationkey AS site_id, c_name AS product_id
FROM customer
UNION ALL
SELECT 'CHG-' || o_orderkey, o_custkey, 'UPDATE', o_orderkey, strftime(o_orderdate, '%Y-%m-%d'),
       o_orderstatus, c_nationkey, c_name
FROM orders JOIN customer ON c_custkey = o_custkey
""")
def cdc_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("batch_id"), F.col("c_nationkey").alias("site_id"), F.col("c_name").alias("product_id"),
        F.lit(0).cast("bigint").alias("sequence_number"), F.lit("1990-01-01").alias("effective_at"),
        F.col("c_mktsegment").alias("release_status"), F.lit("1.0").alias("schema_version"),
    )
    changes = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("CHG-"), F.col("o_orderkey").cast("string")).alias("event_id"),
        F.col("o_custkey").alias("batch_id"), F.lit("UPDATE").alias("operation"),
        F.col("o_orderkey").alias("sequence_number"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("effective_at"),
        F.col("o_orderstatus").alias("release_status"),
        F.lit("orders").alias("source_system"), F.lit("1.0").alias("schema_version"),
    )
    return change_log(customers, changes, carried=("site_id", "product_id")).drop("source_system", "schema_version")


@query("""
SELECT event_id, event_type, CAST(NULL AS VARCHAR) AS analyst_shift FROM events WHERE event_id % 3 <> 0
UNION ALL
SELECT event_id, CAST(NULL AS VARCHAR), 'night' FROM events WHERE event_id % 3 = 0
""")
def union_missing_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    regular = events.filter("event_id % 3 <> 0").select("event_id", "event_type")
    extra = events.filter("event_id % 3 = 0").select("event_id", F.lit("night").alias("analyst_shift"))
    return files.with_extra_files(regular, extra)


@query("""
SELECT event_id, try_cast(props->>'$.k' AS BIGINT) AS k, sha256(props) AS record_hash,
       'stream/partition-' || (event_id % 2) AS source_file
FROM events
""")
def bronze_messages_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = table(spark, sf_dir, "events").select(
        "event_id", F.col("props").alias("value"), F.pmod("event_id", F.lit(2)).cast("int").alias("partition"),
        F.col("event_id").alias("offset"), F.col("ts").alias("timestamp"),
    )
    parsed = bronze.bronze_messages(
        log, "run-1", "stream", contract("k BIGINT"), raw_time="raw_payload", ingested_at=F.lit(None)
    )
    return parsed.select(F.col("offset").alias("event_id"), "k", "record_hash", "source_file")


# --- routing ----------------------------------------------------------------------------------

# Events play telemetry: users are batches, the user's home site is a function of the user id.
EVENTS_SQL = """
WITH src AS (
  SELECT CASE WHEN event_id % 97 = 0 THEN NULL
              WHEN event_id % 89 = 0 THEN event_id - event_id % 890
              ELSE event_id END AS event_key,
         CASE WHEN event_id % 83 = 0 THEN NULL
              WHEN event_id % 79 = 0 THEN -1 ELSE user_id END AS batch_key,
         CASE WHEN event_id % 73 = 0 THEN NULL
              WHEN event_id % 71 = 0 THEN 99 ELSE user_id % 12 END AS site_key,
         CASE WHEN event_id % 67 = 0 THEN '2026-99-77T25:61:00Z'
              ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S') END AS raw_time,
         CASE event_type WHEN 'click' THEN 'temperature_c' WHEN 'view' THEN 'temperature_c'
              WHEN 'error' THEN 'vibration_mm_s' ELSE 'other' END AS metric_name,
         CASE WHEN event_id % 61 = 0 THEN NULL ELSE value END AS value,
         CASE WHEN event_id % 59 = 0 THEN NULL WHEN event_id % 53 = 0 THEN 'F'
              WHEN event_type IN ('click', 'view') THEN 'C' ELSE 'mm/s' END AS unit,
         event_id AS offset_key
  FROM events
), known AS (SELECT c_custkey AS known_batch, c_custkey % 12 AS known_site FROM customer),
ranked AS (
  SELECT src.*, known_batch, known_site, try_cast(raw_time AS TIMESTAMP) AS event_time,
         CASE WHEN event_key IS NULL THEN 1
              ELSE row_number() OVER (PARTITION BY event_key ORDER BY offset_key) END AS rk
  FROM src LEFT JOIN known ON batch_key = known_batch
), evaluated AS (
  SELECT *, CASE WHEN event_key IS NULL THEN 'NULL_EVENT_ID'
    WHEN batch_key IS NULL THEN 'NULL_BATCH_ID'
    WHEN site_key IS NULL THEN 'NULL_SITE_ID'
    WHEN known_batch IS NULL THEN 'UNKNOWN_BATCH'
    WHEN site_key <> known_site THEN 'UNKNOWN_SITE'
    WHEN event_time IS NULL THEN 'MALFORMED_TIMESTAMP'
    WHEN metric_name = 'temperature_c' AND NOT (value BETWEEN -80 AND 80) THEN 'IMPOSSIBLE_TEMPERATURE'
    WHEN (metric_name = 'temperature_c' AND unit <> 'C') OR (metric_name = 'vibration_mm_s' AND unit <> 'mm/s')
      THEN 'INCONSISTENT_UNIT'
    WHEN rk > 1 THEN 'DUPLICATE_EVENT_ID' END AS quarantine_reason
  FROM ranked
)
"""


def _telemetry_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("event_id")

    def every(n: int) -> Column:
        return i % n == 0

    kind = F.col("event_type")
    return table(spark, sf_dir, "events").select(
        F.when(every(97), None).when(every(89), i - i % 890).otherwise(i).alias("event_key"),
        F.when(every(83), None).when(every(79), -1).otherwise(F.col("user_id")).alias("batch_key"),
        F.when(every(73), None).when(every(71), 99).otherwise(F.col("user_id") % 12).alias("site_key"),
        F.when(every(67), "2026-99-77T25:61:00Z")
        .otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"))
        .alias("raw_time"),
        F.when(kind.isin("click", "view"), "temperature_c")
        .when(kind == "error", "vibration_mm_s")
        .otherwise("other")
        .alias("metric_name"),
        F.when(~every(61), F.col("value")).alias("value"),
        F.when(every(59), None)
        .when(every(53), "F")
        .when(kind.isin("click", "view"), "C")
        .otherwise("mm/s")
        .alias("unit"),
        i.alias("offset_key"),
    )


def _routed_events(spark: SparkSession, sf_dir: str) -> Routed:
    warm = F.col("metric_name") == "temperature_c"
    policy = Policy(
        rules=[
            missing("event_key", "NULL_EVENT_ID"),
            missing("batch_key", "NULL_BATCH_ID"),
            missing("site_key", "NULL_SITE_ID"),
            missing(KNOWN + "batch_key", "UNKNOWN_BATCH"),
            differs("site_key", KNOWN + "site_key", "UNKNOWN_SITE"),
            missing(PARSED, "MALFORMED_TIMESTAMP"),
            outside("value", -80.0, 80.0, "IMPOSSIBLE_TEMPERATURE", only=warm),
            wrong_unit(
                "metric_name", "unit", {"temperature_c": "C", "vibration_mm_s": "mm/s"}, "INCONSISTENT_UNIT", False
            ),
            flagged(REPEATED, "DUPLICATE_EVENT_ID"),
        ],
        identity=("event_key",),
        order=(),
        position=("offset_key",),
        raw_time="raw_time",
        lookup_key="batch_key",
        lookup=("site_key",),
        drops=(Expectation("valid_temperature_range", F.col("value").between(-80.0, 80.0)),),
    )
    known = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("batch_key"), (F.col("c_custkey") % 12).alias("site_key")
    )
    return route(_telemetry_events(spark, sf_dir), policy, known)


@query(EVENTS_SQL + "SELECT offset_key, event_key, quarantine_reason FROM evaluated")
def route_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _routed_events(spark, sf_dir).evaluated.select("offset_key", "event_key", REASON)


@query(
    EVENTS_SQL
    + """SELECT offset_key, event_key, batch_key, site_key, metric_name, value, unit,
         strftime(event_time, '%Y-%m-%d %H:%M:%S') AS event_time
         FROM evaluated WHERE quarantine_reason IS NULL AND value BETWEEN -80 AND 80"""
)
def route_events_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid = _routed_events(spark, sf_dir).valid
    return valid.select(
        "offset_key", "event_key", "batch_key", "site_key", "metric_name", "value", "unit",
        F.date_format("raw_time", "yyyy-MM-dd HH:mm:ss").alias("event_time"),
    )


@query(EVENTS_SQL + "SELECT offset_key, raw_time, quarantine_reason FROM evaluated WHERE quarantine_reason IS NOT NULL")
def route_events_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _routed_events(spark, sf_dir).quarantine.select("offset_key", "raw_time", REASON)


@query(
    EVENTS_SQL
    + """SELECT substr(raw_time, 1, 10) AS event_day, quarantine_reason, count(*) AS records
         FROM evaluated WHERE quarantine_reason IS NOT NULL GROUP BY ALL"""
)
def reason_counts_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    evaluated = _routed_events(spark, sf_dir).evaluated
    return reason_counts(evaluated.withColumn("event_day", F.substring("raw_time", 1, 10)), "event_day")


@query(
    EVENTS_SQL
    + """SELECT count(*) AS input_rows,
         count(*) FILTER (quarantine_reason IS NULL AND coalesce(value BETWEEN -80 AND 80, false)) AS valid_rows,
         count(*) FILTER (quarantine_reason IS NOT NULL) AS quarantined_rows,
         count(*) FILTER (quarantine_reason IS NULL AND NOT coalesce(value BETWEEN -80 AND 80, false)) AS dropped_rows,
         true AS balanced FROM evaluated"""
)
def routing_accounting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _routed_events(spark, sf_dir).accounting()


# Line items play quality observations; (order, line) repeats are the real duplicates.
QUALITY_SQL = """
WITH src AS (
  SELECT *, CASE WHEN l_orderkey % 101 = 0 THEN NULL ELSE l_orderkey END AS order_key,
         CASE WHEN l_partkey % 103 = 0 THEN -1 ELSE l_partkey END AS part_key,
         CASE l_returnflag WHEN 'A' THEN 'assay' WHEN 'N' THEN 'purity' ELSE 'bioburden' END AS test_type,
         CASE WHEN l_suppkey % 41 = 0 THEN 'degF' WHEN l_returnflag IN ('A', 'N') THEN '%' ELSE 'CFU/g' END AS unit,
         CASE WHEN l_linenumber = 7 AND l_suppkey % 37 = 0 THEN 145.0 ELSE l_quantity END AS temperature,
         CASE WHEN l_partkey % 107 = 0 THEN 'not a time' ELSE strftime(l_shipdate, '%Y-%m-%d') END AS raw_time
  FROM lineitem
), ranked AS (
  SELECT src.*, p_partkey, try_cast(raw_time AS TIMESTAMP) AS event_time,
         row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate, l_partkey, l_suppkey,
           l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus) AS rk
  FROM src LEFT JOIN part ON part_key = p_partkey
), evaluated AS (
  SELECT *, CASE WHEN order_key IS NULL THEN 'NULL_BUSINESS_KEY'
    WHEN p_partkey IS NULL THEN 'UNKNOWN_BATCH'
    WHEN event_time IS NULL THEN 'MALFORMED_TIMESTAMP'
    WHEN NOT (temperature BETWEEN -80 AND 80) THEN 'IMPOSSIBLE_TEMPERATURE'
    WHEN unit <> CASE WHEN test_type IN ('assay', 'purity') THEN '%' ELSE 'CFU/g' END THEN 'INCONSISTENT_UNIT'
    WHEN rk > 1 THEN 'DUPLICATE_RECORD' END AS quarantine_reason
  FROM ranked
)
"""
LINE_ORDER = (
    "l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus",
)


def _routed_lines(spark: SparkSession, sf_dir: str) -> Routed:
    flag = F.col("l_returnflag")
    lines = stored(spark, sf_dir, "lineitem").withColumns(
        {
            "order_key": F.when(F.col("l_orderkey") % 101 != 0, F.col("l_orderkey")),
            "part_key": F.when(F.col("l_partkey") % 103 == 0, -1).otherwise(F.col("l_partkey")),
            "test_type": F.when(flag == "A", "assay").when(flag == "N", "purity").otherwise("bioburden"),
            "unit": F.when(F.col("l_suppkey") % 41 == 0, "degF").when(flag.isin("A", "N"), "%").otherwise("CFU/g"),
            "temperature": F.when(
                (F.col("l_linenumber") == 7) & (F.col("l_suppkey") % 37 == 0), 145.0
            ).otherwise(F.col("l_quantity")),
            "raw_time": F.when(F.col("l_partkey") % 107 == 0, "not a time").otherwise(
                F.date_format("l_shipdate", "yyyy-MM-dd")
            ),
        }
    )
    policy = Policy(
        rules=[
            missing("order_key", "NULL_BUSINESS_KEY"),
            missing(KNOWN + "part_key", "UNKNOWN_BATCH"),
            missing(PARSED, "MALFORMED_TIMESTAMP"),
            outside("temperature", -80.0, 80.0, "IMPOSSIBLE_TEMPERATURE"),
            wrong_unit("test_type", "unit", {"assay": "%", "purity": "%", "bioburden": "CFU/g"}, "INCONSISTENT_UNIT", True),
            flagged(REPEATED, "DUPLICATE_RECORD"),
        ],
        identity=("l_orderkey", "l_linenumber"),
        order=LINE_ORDER,
        position=POSITION,
        raw_time="raw_time",
        lookup_key="part_key",
    )
    known = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("part_key"))
    return route(lines, policy, known)


@query(
    QUALITY_SQL
    + """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice
         FROM evaluated WHERE quarantine_reason IS NULL"""
)
def route_lineitem_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _routed_lines(spark, sf_dir).valid.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"
    )


@query(
    QUALITY_SQL
    + """SELECT l_orderkey, l_linenumber, l_partkey, raw_time, quarantine_reason
         FROM evaluated WHERE quarantine_reason IS NOT NULL"""
)
def route_lineitem_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _routed_lines(spark, sf_dir).quarantine.select("l_orderkey", "l_linenumber", "l_partkey", "raw_time", REASON)


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate,
       row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate, l_partkey, l_suppkey,
         l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus) > 1 AS is_duplicate
FROM lineitem
""")
def duplicates_without_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    marked = mark_duplicates(lines, ["l_orderkey", "l_linenumber"], LINE_ORDER, "is_duplicate")
    return marked.select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate", "is_duplicate")


@query("""
SELECT doc_id, row_number() OVER (PARTITION BY sha256(text) ORDER BY doc_id) > 1 AS is_duplicate FROM documents
""")
def exact_duplicate_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    hashed = table(spark, sf_dir, "documents").select("doc_id", digest(F.col("text")).alias("text_hash"))
    marked = mark_duplicates(hashed, ["text_hash"], [], "is_duplicate", position=["doc_id"])
    return marked.select("doc_id", "is_duplicate")


# The shipped policies over line items and events, with every reason present. The columns read the same in both
# dialects, so one text serves Spark and the SQL.
OBSERVED = [
    "CASE WHEN l_orderkey % 101 <> 0 THEN l_orderkey * 10 + l_linenumber END AS observation_id",
    "CASE WHEN l_orderkey % 53 = 0 THEN -1 WHEN l_orderkey % 47 <> 0 THEN l_partkey END AS batch_id",
    "CASE WHEN l_orderkey % 59 = 0 THEN 99 WHEN l_orderkey % 43 <> 0 THEN l_partkey % 12 END AS site_id",
    "CASE WHEN l_orderkey % 61 = 0 THEN 99 ELSE l_partkey % 20 END AS product_id",
    "CASE WHEN l_orderkey % 71 = 0 THEN 145.0 ELSE l_quantity END AS sample_temperature_c",
    "CASE l_returnflag WHEN 'A' THEN 'assay' WHEN 'N' THEN 'purity' ELSE 'bioburden' END AS test_type",
    "CASE WHEN l_orderkey % 73 = 0 THEN 'degF' WHEN l_returnflag IN ('A', 'N') THEN '%' ELSE 'CFU/g' END AS unit",
    "l_extendedprice AS result_value",
    "5.0 AS spec_lower",
    "CASE WHEN l_orderkey % 79 <> 0 THEN l_tax END AS spec_upper",
    "CASE WHEN l_orderkey % 67 = 0 THEN 'not a time' ELSE CAST(CAST(l_shipdate AS DATE) AS STRING) END AS event_timestamp_utc",
    "concat(l_orderkey, '-', l_linenumber) AS record_hash",
    *LINE_ORDER,
]


def _observed_sql(rules: str) -> str:
    return f"""
WITH src AS (SELECT {", ".join(OBSERVED)} FROM lineitem),
ranked AS (
  SELECT src.*, p_partkey, try_cast(event_timestamp_utc AS TIMESTAMP) AS event_time,
         row_number() OVER (PARTITION BY record_hash ORDER BY {", ".join(LINE_ORDER)}) AS rk
  FROM src LEFT JOIN part ON batch_id = p_partkey)
SELECT record_hash, observation_id, l_partkey, CASE WHEN observation_id IS NULL THEN 'NULL_BUSINESS_KEY'
    {rules}
    WHEN rk > 1 THEN 'DUPLICATE_RECORD' END AS quarantine_reason
FROM ranked
"""


VALUE_RULES_SQL = """WHEN event_time IS NULL THEN 'MALFORMED_TIMESTAMP'
    WHEN NOT (sample_temperature_c BETWEEN -80 AND 80) THEN 'IMPOSSIBLE_TEMPERATURE'
    WHEN unit <> CASE WHEN test_type = 'bioburden' THEN 'CFU/g' ELSE '%' END THEN 'INCONSISTENT_UNIT'"""


def _observed_reasons(spark: SparkSession, sf_dir: str, policy: Policy) -> DataFrame:
    rows = stored(spark, sf_dir, "lineitem").selectExpr(*OBSERVED, *POSITION)
    known = table(spark, sf_dir, "part").selectExpr(
        "p_partkey AS batch_id", "p_partkey % 12 AS site_id", "p_partkey % 20 AS product_id"
    )
    return route(rows, policy, known).evaluated.select("record_hash", "observation_id", "l_partkey", REASON)


@query(
    _observed_sql(f"""WHEN p_partkey IS NULL THEN 'UNKNOWN_BATCH'
    {VALUE_RULES_SQL}
    WHEN result_value IS NULL OR spec_lower IS NULL OR spec_upper IS NULL THEN 'INVALID_QUALITY_RESULT'""")
)
def quality_policy_basic_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _observed_reasons(spark, sf_dir, quality_policy_basic(order=LINE_ORDER, position=POSITION))


@query(
    _observed_sql(f"""WHEN batch_id IS NULL THEN 'NULL_BATCH_ID'
    WHEN site_id IS NULL THEN 'NULL_SITE_ID'
    WHEN p_partkey IS NULL THEN 'UNKNOWN_BATCH'
    WHEN site_id <> p_partkey % 12 THEN 'UNKNOWN_SITE'
    WHEN product_id <> p_partkey % 20 THEN 'UNKNOWN_PRODUCT'
    {VALUE_RULES_SQL}""")
)
def quality_policy_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _observed_reasons(spark, sf_dir, quality_policy(order=LINE_ORDER, position=POSITION))


@query(
    EVENTS_SQL
    + """SELECT offset_key, event_key AS event_id, CASE WHEN event_key IS NULL THEN 'NULL_EVENT_ID'
    WHEN batch_key IS NULL THEN 'NULL_BATCH_ID'
    WHEN site_key IS NULL THEN 'NULL_SITE_ID'
    WHEN event_time IS NULL THEN 'MALFORMED_TIMESTAMP'
    WHEN metric_name = 'temperature_c' AND NOT (value BETWEEN -80 AND 80) THEN 'IMPOSSIBLE_TEMPERATURE'
    WHEN (metric_name = 'temperature_c' AND unit <> 'C') OR (metric_name = 'vibration_mm_s' AND unit <> 'mm/s')
      THEN 'INCONSISTENT_UNIT'
    WHEN rk > 1 THEN 'DUPLICATE_EVENT_ID' END AS quarantine_reason FROM ranked"""
)
def telemetry_policy_basic_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = {"event_key": "event_id", "batch_key": "batch_id", "site_key": "site_id", "raw_time": "event_timestamp_utc"}
    readings = _telemetry_events(spark, sf_dir).withColumnsRenamed(names)
    policy = telemetry_policy_basic(order=(), position=("offset_key",))
    return route(readings, policy).evaluated.select("offset_key", "event_id", REASON)


# --- expectations -----------------------------------------------------------------------------


def _event_expectations() -> list[Expectation]:
    return [
        Expectation("event_type_known", F.col("event_type").isin("click", "view", "purchase", "signup")),
        Expectation("value_in_domain", F.col("value").between(0.0, 150.0)),
        Expectation("user_present", F.col("user_id").isNotNull()),
    ]


@query("""
SELECT 'event_type_known' AS expectation,
       count(*) FILTER (event_type IN ('click', 'view', 'purchase', 'signup')) AS passed,
       count(*) FILTER (event_type NOT IN ('click', 'view', 'purchase', 'signup')) AS violated FROM events
UNION ALL SELECT 'value_in_domain', count(*) FILTER (value BETWEEN 0 AND 150),
       count(*) FILTER (NOT coalesce(value BETWEEN 0 AND 150, false)) FROM events
UNION ALL SELECT 'user_present', count(user_id), count(*) - count(user_id) FROM events
""")
def expectation_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return expectations.report(table(spark, sf_dir, "events"), _event_expectations())


@query("""
SELECT event_id, event_type, value FROM events
WHERE event_type IN ('click', 'view', 'purchase', 'signup') AND value BETWEEN 0 AND 150 AND user_id IS NOT NULL
""")
def expect_or_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = expectations.drop_violations(table(spark, sf_dir, "events"), _event_expectations())
    return kept.select("event_id", "event_type", "value")


@query("SELECT event_id, value FROM events")
def expect_or_fail(spark: SparkSession, sf_dir: str) -> DataFrame:
    contract = Expectation("known_version", F.col("event_type") != "reserved")
    return expectations.fail_in_plan(table(spark, sf_dir, "events"), contract, "event_id").select("event_id", "value")


@query("""
SELECT 'known_version' AS expectation, CAST(event_id AS VARCHAR) AS offender FROM events
WHERE coalesce(event_type = 'error', true)
""")
def expect_or_fail_offenders(spark: SparkSession, sf_dir: str) -> DataFrame:
    contract = Expectation("known_version", F.col("event_type") != "error")
    return expectations.offenders(table(spark, sf_dir, "events"), contract, "event_id")


# --- history ----------------------------------------------------------------------------------


def _order_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderstatus", "o_orderpriority")


CURRENT_SQL = """
SELECT o_custkey, o_orderkey, o_orderstatus, o_orderpriority FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS rk FROM orders) WHERE rk = 1
"""


@query(CURRENT_SQL)
def current_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.current_state(
        _order_changes(spark, sf_dir), ["o_custkey"], ["o_orderkey"], None, deleted=F.lit(False)
    )


@query(CURRENT_SQL + " AND o_orderkey % 13 <> 0")
def current_state_deletes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.current_state(
        _order_changes(spark, sf_dir), ["o_custkey"], ["o_orderkey"], None, deleted=F.col("o_orderkey") % 13 == 0
    )


FULL_SQL = """
WITH versions AS (
  SELECT c_custkey AS batch_id, c_mktsegment AS release_status, 0::BIGINT AS sequence_number,
         TIMESTAMP '1990-01-01' AS start_time FROM customer
  UNION ALL
  SELECT o_custkey, o_orderstatus, o_orderkey, o_orderdate FROM orders JOIN customer ON o_custkey = c_custkey
), dated AS (
  SELECT *, lead(start_time) OVER (PARTITION BY batch_id ORDER BY start_time, sequence_number) AS end_time FROM versions
)
SELECT batch_id, release_status, sequence_number, strftime(start_time, '%Y-%m-%d') AS effective_start,
       strftime(end_time, '%Y-%m-%d') AS effective_end, end_time IS NULL AS is_current,
       CASE WHEN end_time IS NULL THEN 1 ELSE 0 END AS is_current_int FROM dated
"""


def _full_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    master = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("batch_id"), F.col("c_nationkey").alias("site_id"), F.col("c_name").alias("product_id"),
        F.lit("").alias("lot_number"), F.col("c_mktsegment").alias("release_status"),
        F.lit(0).cast("bigint").alias("sequence_number"), F.lit("1990-01-01").alias("effective_at"),
        F.lit("1.0").alias("schema_version"),
    )
    changes = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("batch_id"), F.col("o_orderstatus").alias("release_status"),
        F.col("o_orderkey").alias("sequence_number"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("effective_at"), F.lit("1.0").alias("schema_version"),
    )
    return history.history_recomputed(master, changes)


@query(FULL_SQL)
def scd2_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _full_history(spark, sf_dir).select(
        "batch_id", "release_status", "sequence_number",
        F.date_format("effective_start_utc", "yyyy-MM-dd").alias("effective_start"),
        F.date_format("effective_end_utc", "yyyy-MM-dd").alias("effective_end"),
        "is_current", "is_current_int",
    )


def _tracked_sql(deleted: str, source: str = "orders") -> str:
    return f"""
WITH ev AS (SELECT o_custkey, o_orderkey, o_orderstatus, o_orderpriority, {deleted} AS gone FROM {source}),
seen AS (SELECT *, lag(o_orderstatus) OVER w AS p, lag(gone) OVER w AS pg, lag(o_orderkey) OVER w AS pk
         FROM ev WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey)),
numbered AS (SELECT *, sum(CASE WHEN pk IS NULL OR pg OR gone OR o_orderstatus IS DISTINCT FROM p THEN 1 ELSE 0 END)
         OVER (PARTITION BY o_custkey ORDER BY o_orderkey ROWS UNBOUNDED PRECEDING) AS v FROM seen),
grouped AS (SELECT o_custkey, v, min(o_orderstatus) AS o_orderstatus, arg_max(o_orderpriority, o_orderkey) AS o_orderpriority,
         min(o_orderkey) AS start_o_orderkey, bool_or(gone) AS gone FROM numbered GROUP BY ALL),
ended AS (SELECT *, lead(start_o_orderkey) OVER (PARTITION BY o_custkey ORDER BY v) AS end_o_orderkey FROM grouped)
SELECT o_custkey, o_orderstatus, o_orderpriority, start_o_orderkey, end_o_orderkey,
       end_o_orderkey IS NULL AS is_current FROM ended WHERE NOT gone
"""


def _tracked(log: DataFrame, deleted: Column) -> DataFrame:
    return history.history_tracked(
        log, keys=["o_custkey"], sequence=["o_orderkey"], tracked=["o_orderstatus"], excluded=(), deleted=deleted
    )


@query(_tracked_sql("false"))
def scd2_tracked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tracked(_order_changes(spark, sf_dir), F.lit(False))


@query(_tracked_sql("o_orderkey % 13 = 0"))
def scd2_with_deletes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tracked(_order_changes(spark, sf_dir), F.col("o_orderkey") % 13 == 0)


@query(
    "WITH t AS (" + _tracked_sql("false") + """)
SELECT o_custkey, o_orderstatus, start_o_orderkey AS sequence_number,
       strftime(TIMESTAMP '2020-01-01' + to_days(CAST(start_o_orderkey % 700 AS INTEGER)), '%Y-%m-%d') AS effective_start,
       is_current, CAST(is_current AS INTEGER) AS is_current_int FROM t
"""
)
def published_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.date_add(F.lit("2020-01-01").cast("date"), (F.col("o_orderkey") % 700).cast("int"))
    log = table(spark, sf_dir, "orders").select(
        "o_custkey", F.col("o_orderkey").alias("sequence_number"), day.cast("string").alias("effective_at"), "o_orderstatus"
    )
    versions = history.history_tracked(
        log, ["o_custkey"], tracked=["o_orderstatus"], excluded=(), deleted=F.lit(False)
    )
    return history.publishable_history(versions).select(
        "o_custkey", "o_orderstatus", "sequence_number",
        F.date_format("effective_start_utc", "yyyy-MM-dd").alias("effective_start"), "is_current", "is_current_int",
    )


# --- facts and KPIs ---------------------------------------------------------------------------

FACT_SQL = """
quality AS (
  SELECT l_orderkey * 10 + l_linenumber AS observation_id, l_suppkey % 12 AS site_id, l_partkey % 20 AS product_id,
         l_partkey AS batch_id, l_returnflag AS returned, l_quantity AS result_value, 5.0::DOUBLE AS spec_lower,
         CASE WHEN l_partkey % 50 = 0 THEN NULL ELSE p_size::DOUBLE END AS spec_upper,
         CAST(l_shipdate AS DATE) AS reporting_date,
         l_quantity BETWEEN 5.0 AND CASE WHEN l_partkey % 50 = 0 THEN NULL ELSE p_size::DOUBLE END AS quality_pass
  FROM lineitem LEFT JOIN part ON l_partkey = p_partkey
)"""


def _quality_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_size")
    return table(spark, sf_dir, "lineitem").join(part, "l_partkey", "left").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("observation_id"),
        F.col("l_partkey").alias("batch_id"),
        (F.col("l_suppkey") % 12).alias("site_id"),
        (F.col("l_partkey") % 20).alias("product_id"),
        F.lit("assay").alias("test_type"),
        F.col("l_quantity").alias("result_value"),
        F.lit(5.0).alias("spec_lower"),
        F.when(F.col("l_partkey") % 50 != 0, F.col("p_size").cast("double")).alias("spec_upper"),
        F.col("l_shipdate").alias("event_timestamp_utc"),
        F.col("l_returnflag").alias("returned"),
    )


@query(
    "WITH " + FACT_SQL + """
SELECT observation_id, site_id, product_id, result_value, spec_lower, spec_upper,
       strftime(reporting_date, '%Y-%m-%d') AS reporting_date, quality_pass FROM quality
"""
)
def quality_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = gold.batch_quality_fact(_quality_rows(spark, sf_dir))
    return fact.select(
        "observation_id", "site_id", "product_id", "result_value", "spec_lower", "spec_upper",
        F.date_format("reporting_date", "yyyy-MM-dd").alias("reporting_date"), "quality_pass",
    )


EXCURSION_SQL = """
limits AS (SELECT c_custkey AS batch_id, c_custkey % 20 AS product_id,
                  CASE WHEN (c_custkey % 20) % 3 = 0 THEN 25.0 ELSE 8.0 END AS limit_c
           FROM customer WHERE c_custkey % 20 < 18),
excursions AS (
  SELECT user_id AS batch_id, event_id % 6 AS sensor_id, user_id % 12 AS site_id, product_id,
         time_bucket(INTERVAL '15 minutes', ts) AS w, min(ts) AS first_ts, max(ts) AS last_ts,
         max(value) AS maximum_temperature_c, count(*) AS event_count
  FROM events JOIN limits ON user_id = batch_id
  WHERE event_type IN ('click', 'view', 'signup') AND value > limit_c GROUP BY 1, 2, 3, 4, 5
), excursion_fact AS (
  SELECT *, sha256(concat_ws('|', batch_id, sensor_id, strftime(w, '%Y-%m-%d %H:%M:%S'))) AS excursion_id,
         (epoch_ms(date_trunc('second', last_ts)) - epoch_ms(date_trunc('second', first_ts))) / 60000.0 AS minutes
  FROM excursions
)"""


def _excursions(spark: SparkSession, sf_dir: str) -> DataFrame:
    readings = table(spark, sf_dir, "events").select(
        "event_id", (F.col("event_id") % 6).alias("sensor_id"), F.col("user_id").alias("batch_id"),
        (F.col("user_id") % 12).alias("site_id"),
        F.when(F.col("event_type").isin("click", "view", "signup"), "temperature_c").otherwise("other").alias("metric_name"),
        "value", F.col("ts").alias("event_timestamp_utc"),
    )
    customers = table(spark, sf_dir, "customer")
    batches = customers.select(
        F.col("c_custkey").alias("batch_id"), (F.col("c_custkey") % 20).alias("product_id"),
        (F.col("c_custkey") % 12).alias("site_id"),
    )
    # Products 18 and 19 have no limit, so their readings cannot exceed one.
    products = batches.select("product_id").distinct().filter("product_id < 18")
    products = products.withColumn("temperature_limit_c", F.when(F.col("product_id") % 3 == 0, 25.0).otherwise(8.0))
    return gold.excursion_fact(readings, batches, products)


@query(
    "WITH " + EXCURSION_SQL + """
SELECT excursion_id, batch_id, sensor_id, site_id, product_id, maximum_temperature_c, event_count,
       strftime(first_ts, '%Y-%m-%d %H:%M:%S') AS excursion_start, strftime(last_ts, '%Y-%m-%d %H:%M:%S') AS excursion_end,
       round(minutes, 6) AS excursion_duration_minutes FROM excursion_fact
"""
)
def excursions_15m(spark: SparkSession, sf_dir: str) -> DataFrame:
    def text(name: str) -> Column:
        return F.date_format(name, "yyyy-MM-dd HH:mm:ss")

    return _excursions(spark, sf_dir).select(
        "excursion_id", "batch_id", "sensor_id", "site_id", "product_id", "maximum_temperature_c", "event_count",
        text("excursion_start_utc").alias("excursion_start"), text("excursion_end_utc").alias("excursion_end"),
        F.round("excursion_duration_minutes", 6).alias("excursion_duration_minutes"),
    )


# Excursions are moved ten years back onto shipping days so that days meet quality days.
KPI_SQL = (
    "WITH " + FACT_SQL + "," + EXCURSION_SQL + """,
q AS (SELECT site_id, product_id, reporting_date, count(DISTINCT batch_id) AS batches_processed,
             count(observation_id) AS n, avg(quality_pass::INT::DOUBLE) AS quality_pass_rate
      FROM quality WHERE returned <> 'R' GROUP BY ALL),
r AS (SELECT l_suppkey % 12 AS site_id, l_partkey % 20 AS product_id, CAST(l_shipdate AS DATE) AS reporting_date,
             count(*) AS records_quarantined FROM lineitem WHERE l_returnflag = 'R' GROUP BY ALL),
x AS (SELECT site_id, product_id, CAST(first_ts - INTERVAL 24 YEAR AS DATE) AS reporting_date,
             count(DISTINCT batch_id) AS batches_with_excursions, avg(minutes) AS mean_minutes,
             quantile_disc(maximum_temperature_c, 0.95) AS p95 FROM excursion_fact GROUP BY ALL)
SELECT q.site_id, q.product_id, strftime(q.reporting_date, '%Y-%m-%d') AS reporting_date, batches_processed,
       coalesce(batches_with_excursions, 0) AS batches_with_excursions,
       round(coalesce(batches_with_excursions, 0) / batches_processed, 9) AS excursion_rate,
       round(coalesce(records_quarantined, 0) / (n + coalesce(records_quarantined, 0)), 9) AS invalid_record_rate,
       round(quality_pass_rate, 9) AS quality_pass_rate,
       round(coalesce(mean_minutes, 0.0), 6) AS mean_excursion_duration_minutes,
       coalesce(p95, 0.0) AS p95_temperature_c, coalesce(records_quarantined, 0) AS records_quarantined
FROM q LEFT JOIN r ON q.site_id = r.site_id AND q.product_id = r.product_id AND q.reporting_date = r.reporting_date
LEFT JOIN x ON q.site_id = x.site_id AND q.product_id = x.product_id AND q.reporting_date = x.reporting_date
"""
)


def _kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Returned items play the quarantined records, all others the accepted ones.
    fact = gold.batch_quality_fact(_quality_rows(spark, sf_dir).filter("returned <> 'R'"))
    returned = table(spark, sf_dir, "lineitem").filter("l_returnflag = 'R'").select(
        (F.col("l_suppkey") % 12).alias("site_id"), (F.col("l_partkey") % 20).alias("product_id"),
        F.col("l_shipdate").alias("event_timestamp_utc"),
    )
    back = F.col("excursion_start_utc") - F.expr("INTERVAL 24 YEARS")
    excursions = _excursions(spark, sf_dir).withColumn("excursion_start_utc", back)
    return gold.daily_kpis(fact, returned, excursions, percentile_accuracy=1_000_000)


@query(KPI_SQL)
def quality_kpi(spark: SparkSession, sf_dir: str) -> DataFrame:
    kpi = _kpis(spark, sf_dir)
    for name in ("excursion_rate", "invalid_record_rate", "quality_pass_rate"):
        kpi = kpi.withColumn(name, F.round(name, 9))
    return kpi.withColumn(
        "mean_excursion_duration_minutes", F.round("mean_excursion_duration_minutes", 6)
    ).withColumn("reporting_date", F.date_format("reporting_date", "yyyy-MM-dd"))


# --- contracts and content --------------------------------------------------------------------


@query("""
SELECT date_trunc('week', l_shipdate)::DATE::VARCHAR AS week, l_returnflag, count(DISTINCT l_partkey) AS parts, count(*) AS records,
       round(avg(CASE WHEN l_quantity >= 10 THEN 1.0 ELSE 0.0 END), 6) AS pass_rate, true AS p95_within_error
FROM lineitem GROUP BY 1, 2
""")
def kpi_weekly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekly KPIs merged from stored daily states. The facts are read again only to judge the sketched quantile."""
    lines, place = table(spark, sf_dir, "lineitem"), workdir(spark, "kpi-states")
    facts = lines.withColumn("day", F.to_date("l_shipdate"))
    state = rollups.daily_state(facts, ["day", "l_returnflag"], F.col("l_partkey"), F.col("l_quantity") >= 10, F.col("l_extendedprice"))
    state.write.parquet(place)
    week = F.trunc("day", "week").cast("string").alias("week")
    kpis = rollups.read_kpis(spark.read.parquet(place).withColumn("week", week), ["week", "l_returnflag"])
    price, found = F.col("l_extendedprice").cast("double"), F.col("quantile")
    ranks = facts.select(week, "l_returnflag", "l_extendedprice").join(kpis, ["week", "l_returnflag"]).groupBy(*kpis.columns).agg(
        F.avg((price < found).cast("double")).alias("below"), F.avg((price <= found).cast("double")).alias("upto")
    )
    # In a group of few rows one row is more than the error.
    error = rollups.RANK_ERROR + 1 / F.col("records")
    within = (F.col("below") <= 0.95 + error) & (F.col("upto") >= 0.95 - error)
    return ranks.select(
        "week", "l_returnflag", F.col("entities").alias("parts"), "records",
        F.round("pass_rate", 6).alias("pass_rate"), within.alias("p95_within_error"),
    )


@query("""
SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem GROUP BY ALL HAVING count(*) > 1
""")
def grain_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contracts.grain_violations(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("""
SELECT 'lineitem' AS table_name, count(*) AS duplicate_keys FROM
  (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
UNION ALL SELECT 'orders', count(*) FROM (SELECT 1 FROM orders GROUP BY o_orderkey HAVING count(*) > 1)
UNION ALL SELECT 'customer', count(*) FROM (SELECT 1 FROM customer GROUP BY c_custkey HAVING count(*) > 1)
""")
def grain_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = {"lineitem": ("l_orderkey", "l_linenumber"), "orders": ("o_orderkey",), "customer": ("c_custkey",)}
    agreed = {name: contracts.TableContract("one row", key, ()) for name, key in keys.items()}
    return contracts.grain_report({name: table(spark, sf_dir, name) for name in keys}, agreed)


@query("""
SELECT o_custkey, CAST(sum(CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END) AS BIGINT) AS current_versions
FROM orders GROUP BY o_custkey HAVING sum(CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END) <> 1
""")
def current_version_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    versions = table(spark, sf_dir, "orders").withColumn("is_current", F.col("o_orderstatus") == "O")
    return contracts.current_version_violations(versions, ["o_custkey"])


@query(
    "WITH h AS (" + FULL_SQL + """), bad AS (SELECT batch_id FROM h GROUP BY 1 HAVING sum(is_current_int) <> 1),
dup AS (SELECT 1 FROM lineitem GROUP BY l_orderkey * 10 + l_linenumber HAVING count(*) > 1)
SELECT 'quality_rows_positive' AS check_name, (SELECT count(*) FROM lineitem) > 0 AS ok, 0::BIGINT AS violations
UNION ALL SELECT 'no_quality_key_duplicates', (SELECT count(*) FROM dup) = 0, (SELECT count(*) FROM dup)
UNION ALL SELECT 'one_current_batch_version', (SELECT count(*) FROM bad) = 0, (SELECT count(*) FROM bad)
UNION ALL SELECT 'kpi_grain_unique', true, 0
"""
)
def validation_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("observation_id")
    )
    published = {
        "fact_batch_quality": lines,
        "dim_batch_history": _full_history(spark, sf_dir),
        "kpi_quality_summary": _kpis(spark, sf_dir),
    }
    return contracts.gold_checks(published)


ROW_TEXT = r"""concat_ws('|', o_orderkey, o_custkey, coalesce(o_orderstatus, '\N'),
  coalesce(CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR), '\N'),
  coalesce(strftime(o_orderdate, '%Y-%m-%d %H:%M:%S'), '\N'), coalesce(o_orderpriority, '\N'))"""


def _order_text() -> Column:
    dated = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    return joined_text(["o_orderkey", "o_custkey", "o_orderstatus", decimal_text("o_totalprice"), dated, "o_orderpriority"])


def _fold_sql(source: str, width: int) -> str:
    return f"""SELECT substr(p, 1, {width}) AS p, sum(n) AS n,
  sha256(string_agg(p || ':' || e, chr(10) ORDER BY p || ':' || e)) AS e FROM {source} GROUP BY 1"""


DIGEST_SQL = f"""
WITH copies AS (SELECT sha256({ROW_TEXT}) AS h, count(*) AS n FROM orders GROUP BY 1),
leaf AS (SELECT substr(h, 1, 9) AS p, sha256(string_agg(h || ':' || n, chr(10) ORDER BY h || ':' || n)) AS e, sum(n) AS n
         FROM copies GROUP BY 1),
six AS ({_fold_sql("leaf", 6)}), three AS ({_fold_sql("six", 3)}), top AS ({_fold_sql("three", 0)})
"""


@query(DIGEST_SQL + "SELECT CAST(n AS BIGINT) AS row_count, e AS content_sha256 FROM top")
def content_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return content.content_digest(table(spark, sf_dir, "orders"), exclude=(), text=_order_text())


_LANES = " || ',' || ".join(
    f"CAST(sum(CAST('0x' || substr(h, {1 + 5 * i}, 5) AS BIGINT)) AS VARCHAR)" for i in range(12)
)


@query(f"""
WITH rows AS (SELECT sha256({ROW_TEXT}) AS h FROM orders)
SELECT count(*) AS row_count, sha256({_LANES}) AS fingerprint FROM rows
""")
def content_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return content.fingerprint(table(spark, sf_dir, "orders"), exclude=(), text=_order_text())


COUNTED = ("customer", "orders", "lineitem", "events", "part", "supplier")


@query(" UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in COUNTED))
def table_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return content.row_counts({name: table(spark, sf_dir, name) for name in COUNTED})


def _receipt(spark: SparkSession, sf_dir: str, lost: int = 0, moved: bool = False) -> DataFrame:
    """A run's whole receipt. ``lost`` leaves out orders below that key; ``moved`` deals them over tasks anew."""
    orders = table(spark, sf_dir, "orders")
    orders = orders.filter(F.col("o_orderkey") >= lost) if lost else orders
    orders = orders.repartition("o_custkey") if moved else orders
    lines = table(spark, sf_dir, "lineitem")
    kpi = lines.groupBy((F.col("l_suppkey") % 12).alias("site_id")).agg(
        F.count_if(F.col("l_returnflag") != "R").alias("batches_processed"),
        F.count_if(F.col("l_returnflag") == "R").alias("records_quarantined"),
        F.avg((F.col("l_quantity") >= 5).cast("double")).alias("quality_pass_rate"),
    )
    versions = orders.withColumn("is_current", F.col("o_orderstatus") == "O")
    return content.run_receipt(
        {"orders": orders, "lineitem": lines},
        {"orders": orders},
        {"lineitem": contracts.grain_violations(lines, ["l_orderkey", "l_linenumber"])},
        contracts.current_version_violations(versions, ["o_custkey"]),
        kpi,
        {"orders": _order_text()},
    )


VIOLATIONS_SQL = """(SELECT count(*) FROM (SELECT 1 FROM orders WHERE o_orderkey >= {lost} GROUP BY o_custkey
  HAVING sum(CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END) <> 1))"""


@query(
    DIGEST_SQL
    + f""", kpi AS (SELECT l_suppkey % 12 AS site_id, count(*) FILTER (l_returnflag <> 'R') AS processed,
  count(*) FILTER (l_returnflag = 'R') AS quarantined, avg(CASE WHEN l_quantity >= 5 THEN 1.0::DOUBLE ELSE 0 END) AS rate
  FROM lineitem GROUP BY 1)
SELECT 'row_counts' AS section, 'orders' AS name, CAST(count(*) AS VARCHAR) AS value FROM orders
UNION ALL SELECT 'row_counts', 'lineitem', CAST(count(*) AS VARCHAR) FROM lineitem
UNION ALL SELECT 'content_hashes', 'orders', e FROM top
UNION ALL SELECT 'duplicate_business_keys', 'lineitem', CAST(count(*) AS VARCHAR)
FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
UNION ALL SELECT 'current_version_violations', 'current_version_violations', CAST({VIOLATIONS_SQL.format(lost=0)} AS VARCHAR)
UNION ALL SELECT 'aggregates', 'batches_processed_sum', CAST(sum(processed) AS VARCHAR) FROM kpi
UNION ALL SELECT 'aggregates', 'records_quarantined_sum', CAST(sum(quarantined) AS VARCHAR) FROM kpi
UNION ALL SELECT 'aggregates', 'mean_quality_pass_rate', CAST(round(avg(rate), 12) AS VARCHAR) FROM kpi
"""
)
def run_receipt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _receipt(spark, sf_dir)


LOST_SQL = "(SELECT count(*) FROM orders WHERE o_orderkey < 1)"
SAME_VIOLATIONS_SQL = f"{VIOLATIONS_SQL.format(lost=0)} = {VIOLATIONS_SQL.format(lost=1)}"


@query(f"""
SELECT 'row_counts' AS section, 'orders' AS name, true AS left_present, {LOST_SQL} = 0 AS matches
UNION ALL SELECT 'row_counts', 'lineitem', true, true
UNION ALL SELECT 'content_hashes', 'orders', true, {LOST_SQL} = 0
UNION ALL SELECT 'duplicate_business_keys', 'lineitem', true, true
UNION ALL SELECT 'current_version_violations', 'current_version_violations', true, {SAME_VIOLATIONS_SQL}
UNION ALL SELECT 'aggregates', unnest(['batches_processed_sum', 'records_quarantined_sum', 'mean_quality_pass_rate']), true, true
""")
def recovery_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    compared = content.compare_receipts(_receipt(spark, sf_dir), _receipt(spark, sf_dir, lost=1))
    return compared.select("section", "name", F.col("clean_value").isNotNull().alias("left_present"), "matches")


@query(f"""
SELECT 'equal' AS recovered, 8::BIGINT AS entries, 0::BIGINT AS mismatches, 'PASS' AS validation
UNION ALL SELECT 'damaged', 8, n, CASE WHEN n = 0 THEN 'PASS' ELSE 'FAIL' END
FROM (SELECT CAST(CASE WHEN {LOST_SQL} > 0 THEN 2 ELSE 0 END + CASE WHEN {SAME_VIOLATIONS_SQL} THEN 0 ELSE 1 END AS BIGINT) AS n)
""")
def recovery_proof(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = _receipt(spark, sf_dir)
    runs = {"equal": _receipt(spark, sf_dir, moved=True), "damaged": _receipt(spark, sf_dir, lost=1)}
    verdicts = [
        content.recovery_verdict(content.compare_receipts(clean, run)).select(F.lit(name).alias("recovered"), "*")
        for name, run in runs.items()
    ]
    return reduce(DataFrame.unionByName, verdicts)


@query("""
SELECT o_orderkey, CASE WHEN o_orderkey % 97 = 0 THEN 'lost' ELSE 'changed' END AS change,
       CAST(1 AS BIGINT) AS left_rows,
       CAST(CASE WHEN o_orderkey % 97 = 0 THEN 0 WHEN o_orderkey % 89 = 0 THEN 1 ELSE 2 END AS BIGINT) AS right_rows
FROM orders WHERE o_orderkey % 97 = 0 OR o_orderkey % 89 = 0 OR o_orderkey % 83 = 0
UNION ALL SELECT -o_orderkey, 'added', 0, 1 FROM orders WHERE o_orderkey % 101 = 0 AND o_orderkey > 0 AND o_orderkey % 97 <> 0
  AND o_orderkey % 89 <> 0 AND o_orderkey % 83 <> 0
""")
def recovery_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which orders a damaged copy lost, changed, doubled or made up, from two stored digest trees."""
    place, orders = workdir(spark, "trees"), table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    dear = F.when(k % 89 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    invented = (k % 101 == 0) & (k > 0) & (k % 89 != 0) & (k % 83 != 0)
    copies = F.when((k % 83 == 0) & (k % 89 != 0), F.array(k, k)).when(invented, F.array(k, -k)).otherwise(F.array(k))
    damaged = orders.filter(k % 97 != 0).withColumn("o_totalprice", dear).withColumn("o_orderkey", F.explode(copies))
    for name, df in (("clean", orders), ("damaged", damaged)):
        difference.write_tree(df, f"{place}/{name}", ["o_orderkey"], exclude=(), text=_order_text())
    return difference.row_differences(spark, f"{place}/clean", f"{place}/damaged", ["o_orderkey"])


LINEAGE_SQL = """
WITH RECURSIVE edges AS (
  SELECT DISTINCT p_partkey AS product, unnest([p_partkey // 2, p_partkey // 3]) AS source FROM part WHERE p_partkey > 0
), reached AS (
  SELECT product, source AS ancestor, 1 AS depth FROM edges
  UNION SELECT r.product, e.source, r.depth + 1 FROM reached r JOIN edges e ON e.product = r.ancestor
), pairs AS (SELECT product, ancestor, min(depth) AS depth FROM reached GROUP BY 1, 2)
SELECT product, count(*) AS ancestors, count(*) FILTER (ancestor = 0) AS sources, CAST(max(depth) AS INTEGER) AS depth,
       bool_or(product = ancestor) AS in_a_circle FROM pairs GROUP BY 1
"""


@query(LINEAGE_SQL)
def lineage_closure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part numbers stand for products; each is made from those of half and a third of its number."""
    parts = table(spark, sf_dir, "part").filter("p_partkey > 0")
    halves = F.explode(F.array(F.floor(F.col("p_partkey") / 2), F.floor(F.col("p_partkey") / 3))).alias("source")
    return lineage.sources_of(lineage.closure(parts.select("p_partkey", halves), "p_partkey", "source"))


@query("""
SELECT 'whole' AS landing, count(DISTINCT event_type) AS files, count(*) AS rows, true AS matches FROM events
UNION ALL SELECT 'one kind lost', count(DISTINCT event_type) - 1, count(*) FILTER (event_type <> 'error'), false FROM events
""")
def landing_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    # What is expected comes from the source table, what is found from the landed files.
    sent = table(spark, sf_dir, "events").agg(F.countDistinct("event_type").alias("files"), F.count(F.lit(1)).alias("rows"))
    expected = sent.first()
    landed = spark.read.text(_event_files(spark, sf_dir))
    cases = {"whole": landed, "one kind lost": landed.filter("kind <> 'error'")}
    found = [
        files.reconcile_landing(scanned, expected.files, expected.rows).select(
            F.lit(name).alias("landing"), "files", "rows", "matches"
        )
        for name, scanned in cases.items()
    ]
    return reduce(DataFrame.unionByName, found)


@query("""
SELECT o_custkey // 100 AS bucket, CAST(sum(length(line) + 1) AS BIGINT) AS bytes,
       sha256(sha256(string_agg(line || chr(10), '' ORDER BY o_orderkey))) AS blocks_sha256
FROM (SELECT *, o_orderkey || '|' || o_custkey || '|' || o_orderstatus || '|' || o_orderpriority AS line FROM orders)
GROUP BY ALL
""")
def file_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    # One file for 100 customers, its lines in key order, so that its bytes are known to SQL.
    place = workdir(spark, "manifest")
    columns = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"]
    lines = table(spark, sf_dir, "orders").select(
        "o_orderkey", joined_text(columns).alias("line"), F.expr("o_custkey div 100").alias("bucket")
    )
    lines = lines.repartition("bucket").sortWithinPartitions("bucket", "o_orderkey")
    lines.select("line", "bucket").write.partitionBy("bucket").text(place)
    bucket = F.regexp_extract("path", r"bucket=(\d+)", 1).cast("bigint").alias("bucket")
    return files.file_manifest(spark, place, "*.txt").select(bucket, "bytes", "blocks_sha256")


@query("""
SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM events WHERE user_id = c_custkey)
""")
def reference_integrity(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return contracts.unresolved_references(customers, "c_custkey", table(spark, sf_dir, "events"), "user_id")


@query("""
SELECT doc_id, lang, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)
""")
def unlabelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    return contracts.unresolved_references(docs, "doc_id", table(spark, sf_dir, "labels"), "doc_id")


@query("""
SELECT l_orderkey, count(*) AS row_count, count(DISTINCT l_linenumber) AS distinct_values,
       min(l_linenumber) AS first_value, max(l_linenumber) AS last_value
FROM lineitem GROUP BY 1
HAVING NOT (count(DISTINCT l_linenumber) = count(*) AND min(l_linenumber) = 1 AND max(l_linenumber) = count(*))
""")
def sequence_integrity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contracts.broken_sequences(table(spark, sf_dir, "lineitem"), ["l_orderkey"], "l_linenumber")


@query("""
SELECT 'no_deletions' AS check_name, count(*) FILTER (o_orderstatus = 'P') = 0 AS ok,
       count(*) FILTER (o_orderstatus = 'P') AS violations FROM orders
UNION ALL
SELECT 'no_unexpected_types', count(*) = 0, count(*) FROM (
  SELECT DISTINCT o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0))
""")
def inventory_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    change = F.when(F.col("o_orderstatus") == "P", "Delete").otherwise("Modify")
    changes = table(spark, sf_dir, "orders").select("o_custkey", change.alias("change_type"))
    expected = table(spark, sf_dir, "customer").filter("c_acctbal > 0")
    return contracts.inventory_checks(changes, "change_type", "o_custkey", expected, "c_custkey")


REGISTRY_SQL = """
WITH a AS (
  SELECT CASE WHEN doc_id % 50 = 0 THEN '' ELSE CAST(doc_id - doc_id % 3 % 2 AS VARCHAR) END AS artifact_id,
         CASE doc_id % 4 WHEN 0 THEN 'VERIFIED' WHEN 1 THEN 'DEMONSTRATED' WHEN 2 THEN 'PRODUCTION_BLUEPRINT' ELSE 'PLANNED' END AS status,
         CASE WHEN doc_id % 12 = 0 THEN ' ' ELSE source END AS receipt,
         CASE WHEN doc_id % 6 = 0 THEN '' ELSE lang END AS limitation FROM documents)
SELECT artifact_id, 'invalid artifact_id' AS rule FROM a WHERE artifact_id = ''
UNION ALL SELECT artifact_id, 'invalid status' FROM a WHERE status = 'PLANNED'
UNION ALL SELECT artifact_id, 'VERIFIED requires receipt' FROM a WHERE status = 'VERIFIED' AND trim(receipt) = ''
UNION ALL SELECT artifact_id, 'PRODUCTION_BLUEPRINT requires limitation' FROM a WHERE status = 'PRODUCTION_BLUEPRINT' AND limitation = ''
UNION ALL SELECT artifact_id, 'duplicate artifact_id' FROM a WHERE artifact_id <> '' GROUP BY artifact_id HAVING count(*) > 1
"""


@query(REGISTRY_SQL)
def registry_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("doc_id")
    filled = [f for f in contracts.ARTIFACT_FIELDS if f not in ("artifact_id", "status", "receipt", "limitation")]
    artifacts = table(spark, sf_dir, "documents").select(
        F.when(i % 50 == 0, "").otherwise((i - i % 3 % 2).cast("string")).alias("artifact_id"),
        F.when(i % 4 == 0, "VERIFIED").when(i % 4 == 1, "DEMONSTRATED").when(i % 4 == 2, "PRODUCTION_BLUEPRINT")
        .otherwise("PLANNED").alias("status"),
        F.when(i % 12 == 0, " ").otherwise(F.col("source")).alias("receipt"),
        F.when(i % 6 == 0, "").otherwise(F.col("lang")).alias("limitation"),
        *[F.lit("x").alias(f) for f in filled],
    )
    return contracts.registry_violations(artifacts)


@query("""
SELECT d.doc_id, lang, coalesce(CAST(quality AS VARCHAR), CAST(toxic AS VARCHAR), 'PENDING') AS captured_at_utc,
       l.doc_id IS NULL AND lang <> 'en' AS receipt_missing
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
""")
def registry_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    labels = table(spark, sf_dir, "labels")
    built = contracts.build_registry(docs, labels, "doc_id", ["quality", "toxic"], F.col("lang") == "en")
    return built.select("doc_id", "lang", "captured_at_utc", "receipt_missing")


# --- text, filters, ledger --------------------------------------------------------------------


@query(r"""
SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(text,
  '[A-Z0-9._%+-]+@[A-Z0-9.-]+\.[A-Z]{2,}', '<redacted-email>', 'gi'),
  '[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}', '<redacted-guid>', 'gi'),
  'Endpoint=sb://[^"\s]+;SharedAccessKeyName=[^;"\s]+;SharedAccessKey=[^;"\s]+', '<redacted-event-hubs-connection>', 'gi'),
  '(sig|se|sp|sv|sr)=[^&"\s]+', '\1=<redacted>', 'gi') AS text
FROM documents
""")
def redact_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents.redacted(table(spark, sf_dir, "documents").select("doc_id", "text"), ["text"])


TERMS = ("copyright", "license", "the", "password", "ention")


@query(f"""
SELECT doc_id, term FROM documents, (SELECT unnest({list(TERMS)}) AS term) t WHERE contains(lower(text), term)
""")
def term_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents.term_hits(table(spark, sf_dir, "documents"), "doc_id", "text", TERMS)


MANY_TERMS_SQL = """
SELECT DISTINCT lower(term) AS term FROM (
  SELECT substr(text, 21, 14) AS term FROM benchmark UNION ALL SELECT substr(text, 60, 9) FROM benchmark
  UNION ALL SELECT substr(text, 5, 3) FROM benchmark UNION ALL SELECT p_name FROM part UNION ALL SELECT c_name FROM customer)
WHERE length(term) > 0
"""


@query(f"SELECT doc_id, term FROM documents, ({MANY_TERMS_SQL}) t WHERE contains(lower(text), term)")
def term_scan_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Thousands of terms, cut from benchmark texts and taken from part and customer names, against all documents."""
    items = table(spark, sf_dir, "benchmark")
    parts = [F.substring("text", start, length) for start, length in ((21, 14), (60, 9), (5, 3))]
    terms = items.select(F.explode(F.array(*parts)).alias("term"))
    terms = terms.union(table(spark, sf_dir, "part").select("p_name")).union(table(spark, sf_dir, "customer").select("c_name"))
    return documents.term_matches(table(spark, sf_dir, "documents"), "doc_id", "text", terms, "term")


@query("""
SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders
WHERE o_orderstatus = 'F' AND contains(lower(concat_ws(' ', o_orderpriority, o_orderstatus)), 'urgent')
""")
def search_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    hits = documents.search(orders, "o_orderstatus", "F", ["o_orderpriority", "o_orderstatus"], " Urgent ")
    return hits.select("o_orderkey", "o_orderstatus", "o_orderpriority")


@query("SELECT event_id, event_type, user_id FROM events WHERE event_type = 'error' AND user_id % 5 = 0")
def alert_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.when(F.col("user_id") % 5 == 0, "Failed").otherwise("Succeeded")
    category = F.when(F.col("event_type") == "error", "Administrative").otherwise("Other")
    events = table(spark, sf_dir, "events").withColumns({"status": status, "category": category})
    return documents.alerts(events, documents.FAILED_ADMINISTRATION).select("event_id", "event_type", "user_id")


@query("SELECT event_type, count(*) AS record_count FROM events GROUP BY 1 ORDER BY 2 DESC, 1")
def log_census(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.census(table(spark, sf_dir, "events"), "event_type")


LEDGER_SQL = """
WITH raw AS (
  SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN 'NaN' WHEN o_orderkey % 7 = 0 THEN '15.00'
              WHEN o_orderkey % 17 = 0 THEN '' ELSE '20' END AS budget,
         CASE WHEN o_orderkey % 19 = 0 THEN 'unknown' WHEN o_orderkey % 23 = 0 THEN '10.005' WHEN o_orderkey % 29 = 0 THEN '-1'
              ELSE CAST(CAST(o_totalprice / 20000 AS DECIMAL(18,3)) AS VARCHAR) END AS cost FROM orders
), parsed AS (
  SELECT *, CASE WHEN budget = 'NaN' THEN NULL ELSE try_cast(budget AS DECIMAL(38,20)) END AS b0,
         try_cast(cost AS DECIMAL(38,20)) AS c0 FROM raw
), amounts AS (
  SELECT *, CASE WHEN b0 > 0 THEN CAST(round_even(b0, 2) AS DECIMAL(38,2)) END AS b,
         CASE WHEN b0 > 0 AND c0 >= 0 THEN CAST(round_even(c0, 2) AS DECIMAL(38,2)) END AS c FROM parsed
)
SELECT o_orderkey, CAST(b AS VARCHAR) AS budget_amount, CAST(c AS VARCHAR) AS cost_amount,
  CASE WHEN b IS NULL THEN 'INVALID_BUDGET' WHEN c IS NULL THEN 'INVALID_CURRENT_COST' WHEN c > b THEN 'BUDGET_EXCEEDED'
       WHEN c = b THEN 'BUDGET_REACHED' WHEN c >= 15 THEN 'RETRY_STOP' WHEN c > 10 THEN 'ABOVE_TARGET'
       WHEN c = 10 THEN 'TARGET_REACHED' ELSE 'WITHIN_TARGET' END AS reason,
  CASE WHEN b IS NULL OR c IS NULL THEN 'STOP' WHEN c >= b THEN 'TEARDOWN' WHEN c >= 15 THEN 'NO_NEW_COMPUTE'
       WHEN c >= 10 THEN 'CONTINUE_WITH_CAUTION' ELSE 'CONTINUE' END AS action,
  coalesce(c < b AND c < 15, false) AS allowed
FROM amounts
"""


@query(LEDGER_SQL)
def cost_gate_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("o_orderkey")
    budget = F.when(i % 11 == 0, "NaN").when(i % 7 == 0, "15.00").when(i % 17 == 0, "").otherwise("20")
    cost = (
        F.when(i % 19 == 0, "unknown")
        .when(i % 23 == 0, "10.005")
        .when(i % 29 == 0, "-1")
        .otherwise((F.col("o_totalprice") / 20000).cast("decimal(18,3)").cast("string"))
    )
    raw = table(spark, sf_dir, "orders").select("o_orderkey", budget.alias("budget"), cost.alias("cost"))
    rated = ledger.cost_gate(raw, "budget", "cost")
    return rated.select(
        "o_orderkey", F.col("budget_amount").cast("string").alias("budget_amount"),
        F.col("cost_amount").cast("string").alias("cost_amount"), "reason", "action", "allowed",
    )


@query("""
SELECT c_custkey AS o_custkey, CAST(amount AS DOUBLE) AS amount,
       CASE WHEN amount IS NULL THEN 'PENDING BILLING SETTLEMENT' ELSE 'CURRENT COST SNAPSHOT' END AS label
FROM customer LEFT JOIN (SELECT o_custkey, sum(CAST(o_totalprice AS DECIMAL(38,6))) AS amount
  FROM orders WHERE o_orderdate >= DATE '2000-01-01' GROUP BY 1) ON o_custkey = c_custkey
""")
def cost_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").filter(F.col("o_orderdate") >= F.lit("2000-01-01").cast("timestamp_ntz"))
    snapshot = ledger.cost_snapshot(
        orders, "o_custkey", "o_totalprice", table(spark, sf_dir, "customer"), "c_custkey"
    )
    return snapshot.withColumn("amount", F.col("amount").cast("double"))


@query("""
SELECT l_returnflag, count(*) AS activities, CAST(sum(l_quantity) AS BIGINT) AS rows_read,
       CAST(sum(l_quantity - CASE WHEN l_orderkey % 5000 = 0 AND l_returnflag = 'R' THEN 1 ELSE 0 END) AS BIGINT) AS rows_copied,
       CAST(sum(l_orderkey) AS BIGINT) AS bytes_written,
       sum(CASE WHEN l_orderkey % 5000 = 0 AND l_returnflag = 'R' THEN 1 ELSE 0 END) = 0 AS reconciled
FROM lineitem GROUP BY 1
""")
def copy_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    lost = F.when((F.col("l_orderkey") % 5000 == 0) & (F.col("l_returnflag") == "R"), 1).otherwise(0)
    rows = F.col("l_quantity").cast("bigint")
    activities = table(spark, sf_dir, "lineitem").select(
        "l_returnflag", rows.alias("rows_read"), (rows - lost).alias("rows_copied"), F.col("l_orderkey").alias("bytes_written")
    )
    return ledger.copy_totals(activities, ["l_returnflag"])


@query("""
SELECT l_returnflag, max(l_extendedprice) AS maximum_duration, quantile_disc(l_extendedprice, 0.75) AS p75_duration
FROM lineitem GROUP BY 1
""")
def nearest_rank_p75(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparison.duration_statistics(table(spark, sf_dir, "lineitem"), "l_returnflag", "l_extendedprice")


@query("""
SELECT l_orderkey, l_linenumber, l_returnflag, CASE WHEN l_suppkey % 7 = 0 THEN l_extendedprice END AS l_extendedprice
FROM lineitem
""")
def published_masked_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    place = workdir(spark, "published")
    layer = place.rsplit("/", 1)[1].replace("-", "_")
    tables.create_layers(spark, [layer], place)
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice", "l_returnflag"
    )
    tables.publish(lines, f"{layer}.lines", partition_by=("l_returnflag",))
    tables.describe_tables(spark, layer, {"lines": "One line of one order."}, {"portfolio.tier": "gold"})
    tables.masking_view(spark, f"{layer}.lines", f"{layer}.lines_masked", ["l_extendedprice"], "l_suppkey % 7 = 0")
    return tables.read_table(spark, f"{layer}.lines_masked").drop("l_suppkey")


# --- files ------------------------------------------------------------------------------------


def _event_files(spark: SparkSession, sf_dir: str) -> str:
    """Events as JSON lines, one file per event type."""
    place = workdir(spark, "json")
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "value", "event_type")
    # Rebalanced by kind: one file a kind where that is small, several where it is large.
    events.withColumn("kind", F.col("event_type")).hint("rebalance", "kind").write.partitionBy("kind").json(place)
    return place


@query("SELECT event_id, user_id, value, event_type, CAST(NULL AS VARCHAR) AS analyst_shift, true AS has_source FROM events")
def json_lines_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = contract("event_id BIGINT, user_id BIGINT, value DOUBLE, event_type STRING, analyst_shift STRING")
    scanned = files.read_json_lines(spark, _event_files(spark, sf_dir), schema)
    has_source = F.col("source_file").endswith(".json").alias("has_source")
    return scanned.select(*schema.fieldNames(), has_source)


BAD_LINES_SQL = """
CASE WHEN event_id % 41 = 0 THEN '{"event_id":' || event_id || ',"user_id":' WHEN event_id % 43 = 0 THEN '[' || event_id || ']'
     WHEN event_id % 47 = 0 THEN '{"event_id":' || event_id || ',"user_id":"none"}'
     ELSE '{"event_id":' || event_id || ',"user_id":' || user_id || '}' END
"""


@query(f"""
SELECT CASE WHEN event_id % 41 = 0 OR event_id % 43 = 0 THEN 'NOT_A_JSON_OBJECT' WHEN event_id % 47 = 0 THEN 'WRONG_TYPE' END AS line_reason,
       CASE WHEN event_id % 41 = 0 OR event_id % 43 = 0 OR event_id % 47 = 0 THEN {BAD_LINES_SQL} END AS raw_line,
       CASE WHEN event_id % 41 = 0 OR event_id % 43 = 0 THEN NULL ELSE event_id END AS event_id,
       CASE WHEN event_id % 41 = 0 OR event_id % 43 = 0 OR event_id % 47 = 0 THEN NULL ELSE user_id END AS user_id
FROM events
""")
def json_lines_bad(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines cut short, arrays and wrong types among good lines: all come out, the bad ones with their text."""
    place = workdir(spark, "bad-lines")
    line = F.expr(BAD_LINES_SQL).alias("value")
    table(spark, sf_dir, "events").select(line).write.text(place)
    return files.scan_json_lines(spark, place, contract("event_id BIGINT, user_id BIGINT")).drop("source_file")


@query("""
SELECT count(DISTINCT event_type) AS activities, count(*) AS rows_read, count(*) AS rows_copied, true AS reconciled FROM events
""")
def landed_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = files.land_files(spark, [f"{_event_files(spark, sf_dir)}/*/*.json"], workdir(spark, "landing"))
    return ledger.copy_totals(landed).drop("bytes_written")


# --- skewed join ------------------------------------------------------------------------------

# Four in five line items move to supplier 0, so one key holds 80 % of the rows.
SKEW_SQL = """
SELECT join_key, s_name, count(*) AS record_count, CAST(sum(l_linenumber) AS BIGINT) AS measure_total,
       strftime(min(l_shipdate), '%Y-%m-%d') AS first_date, strftime(max(l_shipdate), '%Y-%m-%d') AS last_date
FROM (SELECT *, CASE WHEN l_orderkey % 5 < 4 THEN 0 ELSE l_suppkey END AS join_key FROM lineitem) f
JOIN supplier ON join_key = s_suppkey GROUP BY 1, 2
"""


def _skewed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    key = F.when(F.col("l_orderkey") % 5 < 4, F.lit(0)).otherwise(F.col("l_suppkey"))
    facts = table(spark, sf_dir, "lineitem").select(
        key.cast("bigint").alias("join_key"), "l_orderkey", "l_partkey", "l_linenumber", "l_shipdate"
    )
    suppliers = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("join_key"), "s_name")
    return facts, suppliers


def _skew_measures() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("record_count"),
        F.sum("l_linenumber").alias("measure_total"),
        F.date_format(F.min("l_shipdate"), "yyyy-MM-dd").alias("first_date"),
        F.date_format(F.max("l_shipdate"), "yyyy-MM-dd").alias("last_date"),
    ]


@query(SKEW_SQL)
def skew_join_broadcast(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts, suppliers = _skewed(spark, sf_dir)
    return facts.join(broadcast_if_small(suppliers), "join_key").groupBy("join_key", "s_name").agg(*_skew_measures())


@query(SKEW_SQL)
def skew_join_shuffle_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts, suppliers = _skewed(spark, sf_dir)
    spread = F.struct("l_orderkey", "l_partkey", "l_linenumber")
    joined = salted_shuffle_hash_join(facts, suppliers, ["join_key"], spread, salts=16)
    return joined.groupBy("join_key", "s_name").agg(*_skew_measures())


@query(SKEW_SQL)
def skew_join_heavy_hitters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys with a thousandth of the rows or more are joined apart: by broadcast, or salted."""
    facts, suppliers = _skewed(spark, sf_dir)
    spread = F.struct("l_orderkey", "l_partkey", "l_linenumber")
    joined = heavy_hitter_join(facts, suppliers, ["join_key"], spread, salts=16)
    return joined.groupBy("join_key", "s_name").agg(*_skew_measures())


@query(SKEW_SQL)
def skew_join_aggregate_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts, suppliers = _skewed(spark, sf_dir)
    return aggregate_before_join(facts, suppliers, ["join_key"], _skew_measures())


@query("""
SELECT count(DISTINCT s_suppkey) AS row_count, 1::BIGINT AS different_results FROM supplier
WHERE s_suppkey IN (SELECT CASE WHEN l_orderkey % 5 < 4 THEN 0 ELSE l_suppkey END FROM lineitem)
""")
def plans_agree(spark: SparkSession, sf_dir: str) -> DataFrame:
    plans = [skew_join_broadcast, skew_join_shuffle_hash, skew_join_aggregate_first]
    prints = [content.fingerprint(plan(spark, sf_dir), exclude=()) for plan in plans]
    return reduce(DataFrame.unionByName, prints).agg(
        F.max("row_count").alias("row_count"), F.countDistinct("row_count", "fingerprint").alias("different_results")
    )


# --- streams ----------------------------------------------------------------------------------

# A bound that the smallest scale meets too: asking for more messages than there are must fail.
REPLAYED = 1_000


def _event_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.to_json(F.struct("event_id", "user_id", "event_type", "value")).alias("value"),
        F.to_date("ts").alias("day"),
        F.col("event_id").alias("line"),
    )


@query(f"""
SELECT CAST(event_id % 2 AS INTEGER) AS partition, event_id // 2 AS "offset", event_id FROM events
WHERE event_id < {REPLAYED}
""")
def bounded_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Emitting exactly the first N messages is what a bounded replay does; all lines are read.
    target = workdir(spark, "replay")
    messages.replay(_event_lines(spark, sf_dir), REPLAYED, "telemetry", target, ["day"], "line").count()
    sent = spark.read.parquet(target)
    return sent.select("partition", "offset", F.get_json_object("value", "$.event_id").cast("bigint").alias("event_id"))


def _sent_events(spark: SparkSession, sf_dir: str, place: str) -> str:
    """All events as message files, as many as the scan has tasks."""
    sent = messages.as_messages(_event_lines(spark, sf_dir).withColumn("ordinal", F.col("line")), "telemetry")
    sent.write.parquet(f"{place}/messages")
    return f"{place}/messages"


def _bytes_per_trigger(spark: SparkSession, path: str, batches: int = 3) -> str:
    """A rate at which everything sent comes in about this many micro-batches, at every size."""
    listed = spark.read.format("binaryFile").load(path).agg(F.sum("length")).first()[0]
    return str(max(1, listed // batches))


@query("""
SELECT event_id, user_id, event_type, value, 'telemetry/partition-' || (event_id % 2) AS source_file FROM events
""")
def stream_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    place = workdir(spark, "stream-bronze")
    sent = _sent_events(spark, sf_dir, place)
    schema = contract("event_id BIGINT, user_id BIGINT, event_type STRING, value DOUBLE")
    stream = messages.message_file_stream(spark, sent, bytes_per_trigger=_bytes_per_trigger(spark, sent))
    parsed = bronze.bronze_messages(stream, "run-1", "telemetry", schema, raw_time="event_type")
    bronze.append_to_path(parsed, f"{place}/bronze", f"{place}/checkpoint")
    return spark.read.parquet(f"{place}/bronze").select("event_id", "user_id", "event_type", "value", "source_file")


def _progress(spark: SparkSession, sf_dir: str, purpose: str) -> DataFrame:
    place = workdir(spark, purpose)
    sent = _sent_events(spark, sf_dir, place)
    stream = messages.message_file_stream(spark, sent, bytes_per_trigger=_bytes_per_trigger(spark, sent))
    latest = messages.latest_offsets(spark, sent)
    bronze.append_with_progress(stream, f"{place}/bronze", f"{place}/progress", f"{place}/checkpoint", "run-1", latest)
    return bronze.read_progress(spark, f"{place}/progress")


@query("SELECT 'run-1' AS run_id, CAST(count(*) AS BIGINT) AS input_rows, true AS has_offsets FROM events")
def stream_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    progress = bronze.progress_receipt(_progress(spark, sf_dir, "stream-progress"))
    return progress.groupBy("run_id").agg(
        F.sum("input_rows").alias("input_rows"), (F.max(F.length("end_offsets")) > 2).alias("has_offsets")
    )


@query("""
SELECT CAST(event_id % 2 AS INTEGER) AS partition, count(*) AS input_rows, min(event_id // 2) AS first_offset,
       max(event_id // 2) + 1 AS end_offset, max(event_id // 2) + 1 AS latest_offset, CAST(0 AS BIGINT) AS least_lag, true AS lag_is_distance
FROM events GROUP BY 1
""")
def stream_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far each partition was behind, from the progress table: nothing is left behind at the end."""
    distance = F.col("lag") == F.col("latest_offset") - F.col("end_offset")
    return _progress(spark, sf_dir, "stream-lag").groupBy("partition").agg(
        F.sum("input_rows").alias("input_rows"), F.min("first_offset").alias("first_offset"),
        F.max("end_offset").alias("end_offset"), F.max("latest_offset").alias("latest_offset"),
        F.min("lag").alias("least_lag"), F.bool_and(distance).alias("lag_is_distance"),
    )


@query("SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem")
def table_stream_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table read as a stream whose run ends after writing its first micro-batch, uncommitted; the next run repeats it."""
    place = workdir(spark, "table-stream")
    layer = place.rsplit("/", 1)[1].replace("-", "_")
    tables.create_layers(spark, [layer], place)
    tables.publish(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity"), f"{layer}.lines")

    def run(stop: bool) -> None:
        def apply(batch: DataFrame, batch_id: int) -> None:
            bronze.replace_batch(batch, batch_id, f"{place}/lines")
            if stop:
                raise InterruptedError("stopped before the commit")

        stream = tables.read_table_as_stream(spark, f"{layer}.lines")
        bronze.follow(stream, apply, f"{place}/checkpoint")

    try:
        run(stop=True)
    except StreamingQueryException as ended:
        if "stopped before the commit" not in str(ended):
            raise
    run(stop=False)
    return spark.read.parquet(f"{place}/lines").drop(bronze.ARRIVAL)


@query(_tracked_sql("o_orderkey % 13 = 0"))
def stream_scd2(spark: SparkSession, sf_dir: str) -> DataFrame:
    place = workdir(spark, "stream-scd2")
    changes = _order_changes(spark, sf_dir)
    # Three arrivals by a hash of the key, each followed by a run: every sequence is out of order across them.
    arrival = F.pmod(F.xxhash64("o_orderkey"), F.lit(3))
    for number in range(3):
        changes.filter(arrival == number).write.mode("append").parquet(f"{place}/arrivals")
        stream = spark.readStream.schema(changes.schema).parquet(f"{place}/arrivals")
        maintain_history(
            stream, ["o_custkey"], lambda log: _tracked(log, F.col("o_orderkey") % 13 == 0),
            f"{place}/log", f"{place}/history", f"{place}/checkpoint", buckets=8, log_versions=2,
        )
    return read_history(spark, f"{place}/history")
