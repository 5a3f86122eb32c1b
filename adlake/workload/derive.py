"""Report-shaped inputs made from the test tables, row by row and without shuffles.

Every frame here has a SQL twin that builds the same columns relationally, so the
JSON and array handling of the library is checked by a path that has neither.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adlake.plans import specs
from adlake.plans.specs import DailySpec
from adlake.session import SPLIT_BYTES


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread(df: DataFrame, part_bytes: int | None = None) -> DataFrame:
    """Uses all cores where the scan has fewer splits than that (one small file);
    larger inputs have more and are left alone.

    ``part_bytes`` is for rows that become many times wider than they are in the file: no
    partition then comes from more than that many bytes of it, so that what a task derives
    fits its memory when it is sorted or shuffled.
    """
    wanted = df.sparkSession.sparkContext.defaultParallelism
    if part_bytes:
        size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
        wanted = max(wanted, -(-size // part_bytes))
    return df.repartition(wanted) if df.rdd.getNumPartitions() < wanted else df


def as_table(df: DataFrame) -> DataFrame:
    """The derived columns computed once per row, as if read from a table.

    Without it the optimizer copies a derivation into every place that uses one of
    its fields. The generator in between costs no shuffle.
    """
    return df.select(F.inline(F.array(F.struct(*[F.col(c) for c in df.columns]))))


# -- insight rows --------------------------------------------------------------------

ENTRIES = 3  # entries per action array
#: Bytes of the line table that one partition of landing rows is made from: their documents are up to
#: 150 times and their typed columns 20 times as large, so sorting a partition takes some hundred MB of memory.
LANDING_PART_BYTES = 16 << 20

# one landing row per lineitem; the job id is unique so that versions never tie
INSIGHT_SQL = """
ins AS (
  SELECT concat('job_', lpad(CAST(l_orderkey AS VARCHAR), 12, '0'), '_', CAST(l_linenumber AS VARCHAR), '_',
                lpad(CAST(l_partkey AS VARCHAR), 12, '0'), '_', lpad(CAST(l_suppkey AS VARCHAR), 12, '0')) AS job_id,
         CAST(l_shipdate AS TIMESTAMP) + to_hours(48 + l_linenumber) AS created_at,
         concat('act_', l_suppkey % 40) AS account_id,
         concat('Account ', l_suppkey % 40, ' v', l_linenumber) AS account_name,
         CASE WHEN l_returnflag = 'A' THEN 'VND' ELSE '' END AS account_currency,
         concat('c', l_partkey % 50) AS campaign_id,
         concat('Campaign ', l_partkey % 50, ' ', l_linestatus) AS campaign_name,
         concat('s', l_partkey % 200) AS adset_id,
         concat('a', l_partkey % 500) AS ad_id,
         strftime(l_shipdate, '%Y-%m-%d') AS day,
         CAST(l_shipdate AS DATE) AS date_start,
         CASE WHEN l_linenumber <> 6 THEN CAST(l_shipdate AS DATE) END AS date_stop,
         ['18-24', '25-34', '35-44', '45-54', '55-64', '65+'][l_orderkey % 6 + 1] AS age,
         ['male', 'female', 'unknown'][l_orderkey % 3 + 1] AS gender,
         concat('NATION_', l_suppkey % 30, CASE WHEN l_orderkey % 10 = 0 THEN ' ' ELSE '' END) AS region,
         CASE WHEN l_suppkey % 30 < 25 THEN 'VN' ELSE '' END AS country,
         l_extendedprice AS spend,
         CAST(l_quantity * 100 AS INTEGER) * 1.0::DOUBLE AS impressions,
         CAST(l_orderkey % 1000 AS DOUBLE) AS reach,
         CAST(l_linenumber AS DOUBLE) AS clicks,
         l_discount AS ctr,
         CASE WHEN l_linenumber = 3 THEN 0.0 ELSE l_tax END AS cpc,
         CASE WHEN l_linenumber = 5 THEN 0.0 ELSE l_quantity END AS cpm,
         l_discount + 1 AS frequency,
         CAST(l_partkey % 7 AS DOUBLE) AS inline_link_clicks,
         CAST(l_suppkey % 5 AS DOUBLE) AS unique_inline_link_clicks,
         l_tax AS inline_link_click_ctr,
         l_quantity AS cost_per_unique_inline_link_click,
         l_partkey, l_linenumber, l_quantity
  FROM lineitem
)"""


def _job_id() -> Column:
    return F.concat(
        F.lit("job_"), F.lpad(F.col("l_orderkey").cast("string"), 12, "0"),
        F.lit("_"), F.col("l_linenumber").cast("string"),
        F.lit("_"), F.lpad(F.col("l_partkey").cast("string"), 12, "0"),
        F.lit("_"), F.lpad(F.col("l_suppkey").cast("string"), 12, "0"),
    )


def _tagged(prefix: str, column: str, n: int) -> Column:
    return F.concat(F.lit(prefix), (F.col(column) % n).cast("string"))


def _pick(values: list[str], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def _actions(parent: str) -> Column:
    kinds = specs.action_types(parent)
    listed = ", ".join(f"'{k}'" for k in kinds)
    entries = ", ".join(
        f"named_struct('action_type', get(array({listed}), CAST((l_partkey + {e} * l_linenumber) % {len(kinds)} AS INT)),"
        f" 'value', CAST(l_quantity + {e} AS STRING))"
        for e in range(ENTRIES)
    )
    return F.expr(f"CASE WHEN l_linenumber <> 7 THEN array({entries}) END")


def insight_fields(parents: tuple[str, ...]) -> dict[str, Column]:
    line, day = F.col("l_linenumber"), F.date_format("l_shipdate", "yyyy-MM-dd")
    text = lambda c: F.col(c).cast("string")
    out = {
        "account_id": _tagged("act_", "l_suppkey", 40),
        "account_name": F.concat(_tagged("Account ", "l_suppkey", 40), F.lit(" v"), line.cast("string")),
        "account_currency": F.when(F.col("l_returnflag") == "A", "VND"),
        "campaign_id": _tagged("c", "l_partkey", 50),
        "campaign_name": F.concat(_tagged("Campaign ", "l_partkey", 50), F.lit(" "), F.col("l_linestatus")),
        "adset_id": _tagged("s", "l_partkey", 200),
        "ad_id": _tagged("a", "l_partkey", 500),
        "date_start": day,
        "date_stop": F.when(line != 6, day),
        "age": _pick(["18-24", "25-34", "35-44", "45-54", "55-64", "65+"], F.col("l_orderkey") % 6),
        "gender": _pick(["male", "female", "unknown"], F.col("l_orderkey") % 3),
        "region": F.concat(_tagged("NATION_", "l_suppkey", 30), F.when(F.col("l_orderkey") % 10 == 0, " ").otherwise("")),
        "country": F.when(F.col("l_suppkey") % 30 < 25, "VN"),
        "spend": text("l_extendedprice"),
        "impressions": (F.col("l_quantity") * 100).cast("int").cast("string"),
        "reach": (F.col("l_orderkey") % 1000).cast("string"),
        "clicks": line,
        "ctr": F.col("l_discount"),
        "cpc": F.when(line != 3, text("l_tax")),
        "cpm": F.when(line == 5, "n/a").otherwise(text("l_quantity")),
        "frequency": (F.col("l_discount") + 1).cast("string"),
        "inline_link_clicks": F.col("l_partkey") % 7,
        "unique_inline_link_clicks": F.col("l_suppkey") % 5,
        "inline_link_click_ctr": F.col("l_tax"),
        "cost_per_unique_inline_link_click": text("l_quantity"),
    }
    out.update({p: _actions(p) for p in parents})
    return out


def insight_lines(spark: SparkSession, folder: str, spec: DailySpec) -> tuple[DataFrame, Column]:
    """Lines with the job id and time of their landing row, and the column that makes its document of them."""
    cols = insight_fields(spec.parents)
    if spec.spares:
        # every second line number names its ad by id only
        own = cols["ad_id"]
        cols["id"] = own
        cols["ad_id"] = F.when(F.col("l_linenumber") != 2, own)
    payload = F.to_json(F.struct(*[c.alias(n) for n, c in cols.items()]))
    created = F.col("l_shipdate").cast("timestamp") + F.make_interval(hours=F.col("l_linenumber") + 48)
    # cut by the scan, so that no line is shuffled for it; ``spread`` does it where a reader cannot
    spark.conf.set(SPLIT_BYTES, str(LANDING_PART_BYTES))
    lines = spread(table(spark, folder, "lineitem"), LANDING_PART_BYTES)
    return lines.select("*", _job_id().alias("job_id"), created.alias("created_at")), payload


def insight_landing(spark: SparkSession, folder: str, spec: DailySpec) -> DataFrame:
    """Landing rows with the payload of one daily report."""
    lines, document = insight_lines(spark, folder, spec)
    return lines.select("job_id", "created_at", document.alias("data"))


def metric_sql(spec: DailySpec) -> list[str]:
    out = []
    for m in spec.metrics:
        kinds = specs.action_types(m.parent)
        at, n = kinds.index(m.action_type), len(kinds)
        hits = " ".join(
            f"WHEN (l_partkey + {e} * l_linenumber) % {n} = {at} THEN l_quantity + {e}" for e in range(ENTRIES)
        )
        out.append(f"CASE WHEN l_linenumber = 7 THEN 0.0 {hits} ELSE 0.0 END AS {m.name}")
    return out


def daily_sql(spec: DailySpec) -> str:
    """The whole daily model as CTEs ending in one named like the model."""
    key = ["day" if k == "date_start" else k for k in spec.key]
    cols = [
        f"concat_ws('_', {', '.join(key)}) AS surrogate_key", "job_id", "created_at",
        *[out for out, _ in spec.texts], "date_start", "date_stop", *spec.scalars, *metric_sql(spec),
    ]
    return f"""{INSIGHT_SQL},
{spec.name} AS (
  SELECT {', '.join(cols)}
  FROM ins
  QUALIFY row_number() OVER (PARTITION BY {', '.join(key)} ORDER BY created_at DESC, job_id DESC) = 1
)"""


# -- entity rows -----------------------------------------------------------------------

# one landing row per order: an ad of the customer's account, in a changing version
ENTITY_SQL = """
ent AS (
  SELECT concat('job_', lpad(CAST(o_orderkey AS VARCHAR), 12, '0')) AS job_id,
         CAST(o_orderdate AS TIMESTAMP) AS created_at,
         concat('a', o_custkey % 500) AS id,
         concat('Ad ', o_custkey % 500, ' ', o_orderpriority) AS name,
         concat('c', o_custkey % 50) AS campaign_id,
         concat('Campaign ', o_custkey % 50) AS campaign_name,
         concat('s', o_custkey % 200) AS adset_id,
         concat('Set ', o_custkey % 200) AS adset_name,
         concat('cr', o_orderkey % 300) AS creative_id,
         concat('Creative ', o_orderkey % 300) AS creative_name,
         CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE concat('Nội dung ', o_orderkey % 11) END AS creative_body,
         concat('Title ', o_orderkey % 5) AS creative_title,
         concat('https://img.example.com/', o_orderkey % 300) AS creative_thumbnail_url,
         CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE concat('https://facebook.com/', o_orderkey % 97) END
           AS creative_link_url,
         CASE o_orderstatus WHEN 'O' THEN 'ACTIVE' WHEN 'F' THEN 'PAUSED' ELSE 'ARCHIVED' END AS status,
         concat('Page ', o_custkey % 9) AS page_name,
         CAST(o_custkey % 9 AS VARCHAR) AS actor_id,
         ['LOCATION_DETAILED_REPORT', 'AGE & GENDER_DETAILED_REPORT', 'Ad Creative Daily Report',
          'Ad Set Daily Report', 'Campaign Overview Report'][o_orderkey % 5 + 1] AS template
  FROM orders
)"""


def entity_lines(spark: SparkSession, folder: str) -> tuple[DataFrame, Column]:
    """Orders with the job id and time of their landing row, and the column that makes its document of them."""
    o, c = F.col("o_orderkey"), F.col("o_custkey")
    status = F.when(F.col("o_orderstatus") == "O", "ACTIVE").when(F.col("o_orderstatus") == "F", "PAUSED").otherwise("ARCHIVED")
    cols = {
        "id": _tagged("a", "o_custkey", 500),
        "name": F.concat(_tagged("Ad ", "o_custkey", 500), F.lit(" "), F.col("o_orderpriority")),
        "campaign_id": _tagged("c", "o_custkey", 50),
        "campaign_name": _tagged("Campaign ", "o_custkey", 50),
        "adset_id": _tagged("s", "o_custkey", 200),
        "adset_name": _tagged("Set ", "o_custkey", 200),
        "creative_id": _tagged("cr", "o_orderkey", 300),
        "creative_name": _tagged("Creative ", "o_orderkey", 300),
        "creative_body": F.when(o % 4 != 0, _tagged("Nội dung ", "o_orderkey", 11)),
        "creative_title": _tagged("Title ", "o_orderkey", 5),
        "creative_thumbnail_url": F.lit("=IMAGE"),
        "creative_thumbnail_raw_url": _tagged("https://img.example.com/", "o_orderkey", 300),
        "creative_link": F.when(o % 3 != 0, _tagged("https://facebook.com/", "o_orderkey", 97)),
        "status": status,
        "page_name": _tagged("Page ", "o_custkey", 9),
        "actor_id": (c % 9).cast("string"),
        "_template": _pick(
            ["LOCATION_DETAILED_REPORT", "AGE & GENDER_DETAILED_REPORT", "Ad Creative Daily Report",
             "Ad Set Daily Report", "Campaign Overview Report"], o % 5,
        ),
    }
    rows = spread(table(spark, folder, "orders")).select(
        "*",
        F.concat(F.lit("job_"), F.lpad(o.cast("string"), 12, "0")).alias("job_id"),
        F.col("o_orderdate").cast("timestamp").alias("created_at"),
    )
    return rows, F.to_json(F.struct(*[v.alias(n) for n, v in cols.items()]))


def entity_landing(spark: SparkSession, folder: str) -> DataFrame:
    """Landing rows of the entity table that several templates share."""
    rows, document = entity_lines(spark, folder)
    return rows.select("job_id", "created_at", document.alias("data"))


# -- region seed -----------------------------------------------------------------------

SEED_SQL = """
seed AS (
  SELECT concat('VN-', lpad(CAST(n_nationkey AS VARCHAR), 2, '0')) AS region_code, n_name AS region_name,
         CASE WHEN n_nationkey % 4 = 0 THEN 'thành phố' ELSE 'tỉnh' END AS region_type, r_name AS macro_region
  FROM nation JOIN region ON n_regionkey = r_regionkey
  WHERE n_nationkey < 22
)"""


def region_seed(spark: SparkSession, folder: str) -> DataFrame:
    """The seed's columns from nation and region; the last nations are left out on purpose."""
    n, r = table(spark, folder, "nation"), table(spark, folder, "region")
    return n.join(r, n.n_regionkey == r.r_regionkey).filter(F.col("n_nationkey") < 22).select(
        F.concat(F.lit("VN-"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0")).alias("region_code"),
        F.col("n_name").alias("region_name"),
        F.when(F.col("n_nationkey") % 4 == 0, "thành phố").otherwise("tỉnh").alias("region_type"),
        F.col("r_name").alias("macro_region"),
    )
