"""Versions, incremental loads, keyed tables, landing and exports."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlake.operators import latest as lt
from adlake.operators import sets
from adlake.plans import build, gold, silver, specs
from adlake.session import shared_dir
from adlake.sources import files, landing
from adlake.sources.tables import KeyedTable, cache_rows
from adlake.streaming import counters, ingest, lifecycle
from adlake.streaming.warehouse import build_incremental
from adlake.workload import derive as d
from adlake.workload.derive import spread, table
from adlake.workload.joblogs import LIFECYCLE_SQL, job_events
from adlake.workload.registry import query

SPLIT = "1998-06-01"


def orders(spark, folder):
    return table(spark, folder, "orders")


@query(
    "latest_per_key",
    "SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1",
)
def latest_per_key(spark, folder):
    return lt.latest_per_key(orders(spark, folder), ["o_custkey"], "o_orderdate", ["o_orderkey"])


@query(
    "last_wins_map",
    "SELECT l_partkey, l_suppkey, l_extendedprice, concat(l_orderkey, '-', l_linenumber) AS seq FROM lineitem "
    "QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY concat(l_orderkey, '-', l_linenumber) DESC, l_suppkey DESC) = 1",
)
def last_wins_map(spark, folder):
    rows = table(spark, folder, "lineitem").select(
        "l_partkey", "l_suppkey", "l_extendedprice",
        F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string")).alias("seq"),
    )
    return lt.last_wins(rows, ["l_partkey"], "seq")


@query(
    "union_override",
    f"""WITH base AS (SELECT o_custkey AS id, min(o_orderkey) AS seen, 'old' AS origin FROM orders WHERE o_orderdate < TIMESTAMP '{SPLIT}' GROUP BY 1),
new AS (SELECT o_custkey AS id, max(o_orderkey) AS seen, 'new' AS origin FROM orders WHERE o_orderdate >= TIMESTAMP '{SPLIT}' GROUP BY 1)
SELECT * FROM new UNION ALL SELECT * FROM base WHERE id NOT IN (SELECT id FROM new)""",
)
def union_override(spark, folder):
    o, early = orders(spark, folder), F.col("o_orderdate") < F.lit(SPLIT).cast("timestamp_ntz")
    base = o.filter(early).groupBy(F.col("o_custkey").alias("id")).agg(F.min("o_orderkey").alias("seen")).withColumn("origin", F.lit("old"))
    new = o.filter(~early).groupBy(F.col("o_custkey").alias("id")).agg(F.max("o_orderkey").alias("seen")).withColumn("origin", F.lit("new"))
    return lt.override(base, new, ["id"])


@query(
    "dim_distinct_latest",
    """SELECT o_custkey, o_orderstatus, o_orderpriority, o_orderdate FROM (SELECT DISTINCT o_custkey, o_orderstatus, o_orderpriority, o_orderdate FROM orders)
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderstatus DESC, o_orderpriority DESC) = 1""",
)
def dim_distinct_latest(spark, folder):
    return lt.distinct_dimension(orders(spark, folder), ["o_custkey"], ["o_orderstatus", "o_orderpriority"], "o_orderdate")


@query(
    "delete_insert",
    f"""WITH target AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '{SPLIT}'),
delta AS (SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '{SPLIT}' AND o_orderstatus = 'F')
SELECT * FROM delta UNION ALL SELECT * FROM target WHERE o_custkey NOT IN (SELECT o_custkey FROM delta)""",
)
def delete_insert(spark, folder):
    o, early = orders(spark, folder), F.col("o_orderdate") < F.lit(SPLIT).cast("timestamp_ntz")
    return lt.replace_keys(o.filter(early), o.filter(~early & (F.col("o_orderstatus") == "F")), ["o_custkey"])


CAMPAIGN_SQL = f"WITH {d.daily_sql(specs.CAMPAIGN)} SELECT * FROM stg_campaign_daily"


@query("incremental_equals_full", CAMPAIGN_SQL)
def incremental_equals_full(spark, folder):
    """The campaign model loaded in three watermark slices; one pass must give the same."""
    raw = d.insight_landing(spark, folder, specs.CAMPAIGN)
    cuts = [None, "1997-03-01 00:00:00", "1999-07-01 00:00:00", None]
    state = None
    for low, high in zip(cuts, cuts[1:], strict=False):
        rows = lt.newer_than(raw, low)
        if high is not None:
            rows = rows.filter(F.col("created_at") <= F.lit(high).cast("timestamp"))
        delta = silver.daily(rows, specs.CAMPAIGN)
        state = delta if state is None else lt.merge_latest(state, delta, ["surrogate_key"], ties=["job_id"])
    return state


@query("stream_incremental_silver", CAMPAIGN_SQL)
def stream_incremental_silver(spark, folder):
    """Landing files through a stream into a keyed table."""
    root = shared_dir(spark, "ingest")
    source = specs.CAMPAIGN.source
    lines, document = d.insight_lines(spark, folder, specs.CAMPAIGN)
    landing.append_raw(f"{root}/landing", source, lines, grain="MM", many_days=True, document=document)
    out = KeyedTable(f"{root}/silver", build.daily_schema(specs.CAMPAIGN), ("surrogate_key",), ties=("job_id",))
    stream = ingest.landing_stream(spark, f"{root}/landing", source)
    ingest.upsert_stream(stream, lambda raw: silver.settled_daily(raw, specs.CAMPAIGN), out, f"{root}/checkpoint").awaitTermination()
    return out.read(spark)


FACT_SQL = (
    f"WITH {d.daily_sql(specs.CAMPAIGN)} SELECT "
    + ", ".join(f"CAST({c} AS DATE) AS {out}" if c in ("date_start", "date_stop") else c if c == out else f"{c} AS {out}" for out, c in gold.CAMPAIGN_FACT)
    + " FROM stg_campaign_daily"
)


@query("build_incremental", FACT_SQL)
def build_incremental_fact(spark, folder):
    """All fourteen models through the landing streams, with loads landed out of order and a repeated batch.

    The newest rows of every landing table land first and are built; then the oldest (committed late,
    older than everything the tables hold) and the rest land, and the next run builds them. After it
    the campaign stream's last commit is taken back, so a third run repeats that batch. The gold fact
    must equal one pass over all rows.
    """
    root = shared_dir(spark, "warehouse")
    lands, checkpoint = f"{root}/landing", f"{root}/checkpoint"
    house = build.Warehouse(f"{root}/house")
    seed = d.region_seed(spark, folder)
    as_of = F.lit("2024-01-31 00:00:00").cast("timestamp")
    sources = {spec.source: d.insight_lines(spark, folder, spec) for spec in specs.DAILY}
    sources[landing.SHARED_METADATA] = d.entity_lines(spark, folder)
    newest = F.col("created_at") >= F.lit("1997-01-01").cast("timestamp")
    for loads in ([newest], [F.col("created_at") < F.lit("1994-01-01").cast("timestamp"), ~newest & (F.col("created_at") >= F.lit("1994-01-01").cast("timestamp"))]):
        for part in loads:
            for name, (lines, document) in sources.items():
                landing.append_raw(lands, name, lines.filter(part), grain="MM", many_days=True, document=document)
        build_incremental(spark, lands, house, seed, checkpoint, as_of)
    commits = f"{checkpoint}/{specs.CAMPAIGN.source}/commits"
    last = max(int(n) for n in files.children(spark, commits) if n.isdigit())
    files.remove(spark, f"{commits}/{last}")
    build_incremental(spark, lands, house, seed, checkpoint, as_of)
    return house.gold["fact_campaigns_daily"].read(spark)


def _event_stream(spark, folder):
    schema = table(spark, folder, "events").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(folder)


@query(
    "stream_hourly_calls",
    "SELECT event_type AS endpoint, date_trunc('hour', ts) AS hour, count(*) AS calls FROM events GROUP BY ALL",
)
def stream_hourly_calls(spark, folder):
    root = shared_dir(spark, "hourly")
    counts = counters.hourly_counts(_event_stream(spark, folder), "event_type", "ts")
    ingest.update_stream(counts, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return ingest.read_updates(spark, f"{root}/out", ["endpoint", "hour"])


@query("stream_job_lifecycle", LIFECYCLE_SQL)
def stream_job_lifecycle(spark, folder):
    root = shared_dir(spark, "lifecycle")
    events = job_events(_event_stream(spark, folder))
    lifecycle.run_lifecycle(events, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return lifecycle.read_jobs(spark, f"{root}/out")


# -- report cache ------------------------------------------------------------------------

CACHE_SQL = """
cached AS (
  SELECT concat_ws('_', 'me@example.com', 'adv', 'st', concat('c', l_suppkey), concat('g', l_partkey), concat('i', l_orderkey, '_', l_linenumber),
                   '2024-01-01', '2024-01-31', strftime(l_shipdate, '%Y-%m-%d')) AS _id,
         concat('c', l_suppkey) AS campaign_id, CASE WHEN l_returnflag = 'R' THEN 'again' ELSE 'first' END AS note,
         l_extendedprice AS gross_revenue, 'me@example.com' AS user_email,
         CASE WHEN l_returnflag = 'R' THEN TIMESTAMP '2024-02-02 00:00:00' ELSE TIMESTAMP '2024-02-01 00:00:00' END AS updated_at
  FROM lineitem
)"""
CACHE_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("_id", "campaign_id", "note")]
    + [T.StructField("gross_revenue", T.DoubleType()), T.StructField("user_email", T.StringType()), T.StructField("updated_at", T.TimestampType())]
)


def report_cache(spark, folder):
    """All lines saved once, then the returned ones saved again: a real table, upserted."""
    rows = _cache_lines(spark, folder)
    first = cache_rows(rows.withColumn("note", F.lit("first")), "me@example.com", "2024-02-01 00:00:00")
    again = cache_rows(rows.filter(F.col("l_returnflag") == "R").withColumn("note", F.lit("again")), "me@example.com", "2024-02-02 00:00:00")
    cache = KeyedTable(shared_dir(spark, "cache"), CACHE_SCHEMA, ("_id",), version="updated_at")
    cache.upsert(first)
    cache.upsert(again)
    return cache.read(spark)


def _cache_lines(spark, folder):
    text = lambda c: F.col(c).cast("string")
    return spread(table(spark, folder, "lineitem")).select(
        F.lit("adv").alias("advertiser_id"), F.lit("st").alias("store_id"),
        F.concat(F.lit("c"), text("l_suppkey")).alias("campaign_id"), F.concat(F.lit("g"), text("l_partkey")).alias("item_group_id"),
        F.concat(F.lit("i"), text("l_orderkey"), F.lit("_"), text("l_linenumber")).alias("item_id"),
        F.lit("2024-01-01").alias("start_date"), F.lit("2024-01-31").alias("end_date"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("stat_time_day"), F.col("l_extendedprice").alias("gross_revenue"), "l_returnflag",
    )


@query("report_cache_upsert", f"WITH {CACHE_SQL} SELECT * FROM cached")
def report_cache_upsert(spark, folder):
    return report_cache(spark, folder)


@query("report_cache_find", f"WITH {CACHE_SQL} SELECT * FROM cached WHERE campaign_id = 'c7' AND note = 'again'")
def report_cache_find(spark, folder):
    return sets.matching(report_cache(spark, folder), campaign_id="c7", note="again")


# -- deletes, landing, exports --------------------------------------------------------------

_OLD = "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P'"


@query("delete_rows", f"SELECT * FROM orders WHERE o_orderkey NOT IN ({_OLD})")
def delete_rows(spark, folder):
    o = orders(spark, folder)
    return sets.delete_keys(o, o.filter(F.col("o_orderstatus") == "P"), "o_orderkey")


@query("delete_count", f"SELECT count(*) AS deleted_count FROM orders WHERE o_orderkey IN ({_OLD})")
def delete_count(spark, folder):
    o = orders(spark, folder)
    return sets.delete_count(o, o.filter(F.col("o_orderstatus") == "P"), "o_orderkey")


@query(
    "landing_roundtrip",
    """SELECT 'raw_fb_ad_daily_report_metrics' AS table_name, 'job_1' AS job_id, CAST(o_orderkey AS VARCHAR) AS id, o_orderpriority AS label,
  'Ad Daily Report' AS template FROM orders
UNION ALL SELECT 'raw_fb_metadata_shared', 'job_1', CAST(c_custkey AS VARCHAR), concat('Tên ', c_name), 'Ad Daily Report' FROM customer""",
)
def landing_roundtrip(spark, folder):
    """A report landed as metrics and shared entities, read back and parsed."""
    root = shared_dir(spark, "landing")
    metrics = orders(spark, folder).select(F.col("o_orderkey").cast("string").alias("id"), F.col("o_orderpriority").alias("label"))
    entities = table(spark, folder, "customer").select(
        F.col("c_custkey").cast("string").alias("id"), F.concat(F.lit("Tên "), F.col("c_name")).alias("label")
    )
    landing.land_report(root, "Ad Daily Report", "job_1", metrics, entities)
    parts = []
    for name in ("raw_fb_ad_daily_report_metrics", landing.SHARED_METADATA):
        p = F.from_json("data", "id string, label string, _template string")
        raw = landing.read_raw(spark, root, name).select("job_id", p.alias("p"))
        parts.append(
            raw.select(F.lit(name).alias("table_name"), "job_id", "p.id", "p.label", F.col("p._template").alias("template"))
        )
    return sets.concat(*parts)


@query("export_roundtrip", "SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, NULL::VARCHAR AS absent, CAST(p_retailprice AS VARCHAR) AS p_retailprice FROM part")
def export_roundtrip(spark, folder):
    """Chosen columns as CSV with a header, read back as text."""
    path = shared_dir(spark, "export")
    headers = ["p_partkey", "p_name", "absent", "p_retailprice"]
    files.export_table(table(spark, folder, "part"), path, headers)
    return spark.read.option("header", True).schema(", ".join(f"{h} string" for h in headers)).csv(path)


@query("json_dump_roundtrip", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def json_dump_roundtrip(spark, folder):
    path = shared_dir(spark, "dump")
    files.dump_json(table(spark, folder, "customer").select("c_custkey", "c_name", "c_acctbal"), path)
    return spark.read.schema("c_custkey bigint, c_name string, c_acctbal double").json(path)
