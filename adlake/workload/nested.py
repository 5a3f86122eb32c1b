"""Nested API answers and shop reports made from orders, customers, line items and parts."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlake import schemas
from adlake.operators import enrich, pivot, unnest
from adlake.plans import ads, shop
from adlake.plans.templates import spending
from adlake.schemas import texts
from adlake.session import shared_dir
from adlake.sources.files import read_pages
from adlake.workload import derive as d
from adlake.workload.derive import as_table, spread, table
from adlake.workload.registry import query

AS_OF = "2024-01-31 00:00:00"


# -- insight pages -----------------------------------------------------------------------

INSIGHT_ITEM = texts("ad_id", "id", "account_id", "spend", "impressions", "date_start", "date_stop")


def insight_pages(spark, folder, ads_: int | None = 500):
    """Each order as one answer page with two rows; the second names its ad by ``id`` only.

    Ads are the customers, folded to ``ads_`` of them if given.
    """
    o, c = F.col("o_orderkey"), F.col("o_custkey")
    ad = F.concat(F.lit("a"), (c % ads_ if ads_ else c).cast("string"))
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    none = F.lit(None).cast("string")

    def row(ad_id, own_id, spend):
        cols = [ad_id, own_id, F.lit("other"), spend, (o % 90).cast("string"), day, day]
        return F.struct(*[c.alias(n) for n, c in zip(INSIGHT_ITEM.fieldNames(), cols, strict=True)])

    amount = F.col("o_totalprice").cast("string")
    return table(spark, folder, "orders").select(
        F.concat(F.lit("act_"), (c % 40).cast("string")).alias("account_id"),
        F.concat(F.lit("Account "), (c % 40).cast("string")).alias("account_name"),
        F.array(row(ad, none, amount), row(none, ad, F.when(o % 4 == 0, "0").otherwise(amount))).alias("data"),
    )


PAGES_SQL = """
pages_ AS (
  SELECT o_orderkey, concat('act_', o_custkey % 40) AS account_id, concat('Account ', o_custkey % 40) AS account_name,
         concat('a', o_custkey % 500) AS ad_id, CASE WHEN e = 1 THEN concat('a', o_custkey % 500) END AS id,
         CASE WHEN e = 1 AND o_orderkey % 4 = 0 THEN '0' ELSE CAST(o_totalprice AS VARCHAR) END AS spend,
         CAST(o_orderkey % 90 AS VARCHAR) AS impressions,
         strftime(o_orderdate, '%Y-%m-%d') AS date_start, strftime(o_orderdate, '%Y-%m-%d') AS date_stop
  FROM orders, (VALUES (0), (1)) t(e)
)"""


@query("insight_rows", f"WITH {PAGES_SQL} SELECT * EXCLUDE (o_orderkey) FROM pages_")
def insight_rows(spark, folder):
    return unnest.insight_rows(insight_pages(spark, folder), "ad")


@query("api_page_scan", f"WITH {PAGES_SQL} SELECT * EXCLUDE (o_orderkey) FROM pages_")
def api_page_scan(spark, folder):
    """The same pages landed as JSON files, read back with the envelope schema."""
    path = shared_dir(spark, "pages")
    pages = insight_pages(spark, folder).withColumn("paging", F.struct(F.lit("next").alias("next")))
    pages.write.json(path)
    context = texts("account_id", "account_name")
    return unnest.insight_rows(read_pages(spark, path, INSIGHT_ITEM, context), "ad")


# -- breakdown pages ---------------------------------------------------------------------


@query(
    "breakdown_report",
    """SELECT concat('act_', l_suppkey % 40) AS account_id, concat('Account ', l_suppkey % 40) AS account_name,
  CASE WHEN l_linenumber = 2 THEN '1995-01-01' ELSE strftime(l_shipdate, '%Y-%m-%d') END AS date_start,
  CASE WHEN l_linenumber = 2 THEN '2001-12-31' ELSE strftime(l_shipdate, '%Y-%m-%d') END AS date_stop,
  CASE WHEN l_linenumber % 2 = 0 THEN concat(l_orderkey % 24, ':00:00') ELSE '' END AS hour_of_day,
  CASE WHEN l_linenumber % 2 = 0 THEN concat(l_orderkey % 24, ':00:00') END AS hourly_stats_aggregated_by_audience_time_zone,
  concat('c', l_partkey % 50) AS campaign_id, l_returnflag AS age, l_linestatus AS gender,
  CAST(l_extendedprice AS VARCHAR) AS spend FROM lineitem""",
)
def breakdown_report(spark, folder):
    """Each line item as a page with one breakdown row; some rows lack their dates."""
    line = F.col("l_linenumber")
    day = F.when(line != 2, F.date_format("l_shipdate", "yyyy-MM-dd")).otherwise("")
    hour = F.when(line % 2 == 0, F.concat((F.col("l_orderkey") % 24).cast("string"), F.lit(":00:00")))
    item = F.struct(
        F.concat(F.lit("c"), (F.col("l_partkey") % 50).cast("string")).alias("campaign_id"),
        F.lit("other").alias("account_id"), F.col("l_returnflag").alias("age"), F.col("l_linestatus").alias("gender"),
        day.alias("date_start"), day.alias("date_stop"), hour.alias(unnest.HOURLY),
        F.col("l_extendedprice").cast("string").alias("spend"),
    )
    pages = table(spark, folder, "lineitem").select(
        F.concat(F.lit("act_"), (F.col("l_suppkey") % 40).cast("string")).alias("account_id"),
        F.concat(F.lit("Account "), (F.col("l_suppkey") % 40).cast("string")).alias("account_name"),
        F.lit("1995-01-01").alias("start_date"), F.lit("2001-12-31").alias("end_date"),
        F.array(item).alias("data"),
    )
    return ads.breakdown_report(pages)


# -- performance pages -------------------------------------------------------------------


def _creative(key: str):
    n = F.col(key)
    story = F.when(n % 3 != 0, F.concat(F.lit("s"), (n % 97).cast("string")))
    thumb = F.when(n % 4 != 0, F.concat(F.lit("https://img.example.com/"), (n % 300).cast("string"))).otherwise("")
    return F.struct(
        F.concat(F.lit("cr"), (n % 300).cast("string")).alias("id"), F.lit("Creative").alias("name"),
        F.concat(F.lit("Title "), (n % 5).cast("string")).alias("title"), F.lit(None).cast("string").alias("body"),
        (n % 30).cast("string").alias("actor_id"), thumb.alias("thumbnail_url"), story.alias("object_story_id"),
    )


def page_table(spark, folder):
    return table(spark, folder, "nation").select(F.col("n_nationkey").alias("page_id"), F.col("n_name").alias("page_name"))


_PAGE_SQL = "coalesce(n_name, 'Page không xác định')"


@query(
    "performance_report",
    f"""WITH o AS (SELECT *, o_custkey % 6 <> 5 AS has_creative FROM orders)
SELECT concat('a', o_orderkey) AS id, concat('Ad ', o_orderkey) AS name,
  ['ACTIVE','PAUSED','DISAPPROVED','ARCHIVED'][o_orderkey % 4 + 1] AS effective_status,
  CASE WHEN o_orderkey % 9 <> 0 THEN CAST(o_totalprice AS VARCHAR) ELSE 'none' END AS spend,
  CASE WHEN o_orderkey % 9 <> 0 THEN '7' END AS clicks,
  CASE WHEN has_creative THEN concat('cr', o_orderkey % 300) END AS creative_id,
  CASE WHEN has_creative THEN concat('Title ', o_orderkey % 5) END AS creative_title,
  CASE WHEN has_creative THEN '' END AS creative_body,
  CASE WHEN has_creative THEN CAST(o_orderkey % 30 AS VARCHAR) END AS actor_id,
  CASE WHEN has_creative THEN CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE concat('=IMAGE("https://img.example.com/', o_orderkey % 300, '")') END END
    AS creative_thumbnail_url,
  CASE WHEN has_creative THEN CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE concat('https://img.example.com/', o_orderkey % 300) END END
    AS creative_thumbnail_raw_url,
  CASE WHEN has_creative THEN CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE concat('https://facebook.com/s', o_orderkey % 97) END END AS creative_link,
  concat('c', o_custkey % 50) AS campaign_id, concat('Campaign ', o_custkey % 50) AS campaign_name,
  concat('s', o_custkey % 200) AS adset_id, concat('Set ', o_custkey % 200) AS adset_name,
  concat('act_', o_custkey % 40) AS account_id, concat('Account ', o_custkey % 40) AS account_name,
  '2024-01-01' AS date_start, '2024-01-31' AS date_stop,
  CASE WHEN has_creative THEN {_PAGE_SQL} END AS page_name
FROM o LEFT JOIN nation ON n_nationkey = o_orderkey % 30""",
)
def performance_report(spark, folder):
    """Each order as a page with one ad, its creative and one total insight."""
    o, c = F.col("o_orderkey"), F.col("o_custkey")
    tag = lambda p, col, n: F.concat(F.lit(p), (col % n).cast("string"))
    insight = F.struct(F.col("o_totalprice").cast("string").alias("spend"), F.lit("7").alias("clicks"))
    item = F.struct(
        F.concat(F.lit("a"), o.cast("string")).alias("id"), F.concat(F.lit("Ad "), o.cast("string")).alias("name"),
        d._pick(["ACTIVE", "PAUSED", "DISAPPROVED", "ARCHIVED"], o % 4).alias("effective_status"),
        F.lit("none").alias("spend"),
        F.struct(tag("c", c, 50).alias("id"), tag("Campaign ", c, 50).alias("name")).alias("campaign"),
        F.struct(tag("s", c, 200).alias("id"), tag("Set ", c, 200).alias("name")).alias("adset"),
        F.when(c % 6 != 5, _creative("o_orderkey")).alias("creative"),
        F.when(o % 9 != 0, F.struct(F.array(insight).alias("data"))).alias("insights"),
    )
    pages = table(spark, folder, "orders").select(
        tag("act_", c, 40).alias("account_id"), tag("Account ", c, 40).alias("account_name"),
        F.lit("2024-01-01").alias("start_date"), F.lit("2024-01-31").alias("end_date"), F.array(item).alias("data"),
    )
    return ads.performance_report(pages, page_table(spark, folder), "ad")


# -- daily report with entities ------------------------------------------------------------

OBJECTS_SQL = f"""
objects AS (
  SELECT concat('a', c_custkey) AS id, concat('Ad ', c_name) AS name, concat('c', c_custkey % 50) AS campaign_id,
         concat('Campaign ', c_custkey % 50) AS campaign_name, concat('s', c_custkey % 200) AS adset_id,
         concat('Set ', c_custkey % 200) AS adset_name, 'LOWEST' AS adset_bid_strategy,
         CASE c_custkey % 3 WHEN 0 THEN '10' WHEN 1 THEN '20' ELSE '30' END AS adset_bid_amount,
         'Creative' AS creative_name, concat('cr', c_custkey % 300) AS creative_id, concat('Title ', c_custkey % 5) AS creative_title,
         '' AS creative_body, CAST(c_custkey % 30 AS VARCHAR) AS actor_id,
         CASE WHEN c_custkey % 4 = 0 THEN '' ELSE concat('=IMAGE("https://img.example.com/', c_custkey % 300, '")') END AS creative_thumbnail_url,
         CASE WHEN c_custkey % 4 = 0 THEN '' ELSE concat('https://img.example.com/', c_custkey % 300) END AS creative_thumbnail_raw_url,
         CASE WHEN c_custkey % 3 = 0 THEN '' ELSE concat('https://facebook.com/s', c_custkey % 97) END AS creative_link,
         c_mktsegment AS status, {_PAGE_SQL} AS page_name
  FROM customer LEFT JOIN nation ON n_nationkey = c_custkey % 30
)"""


def objects(spark, folder):
    """One fetched ad object per customer."""
    n = F.col("c_custkey")
    tag = lambda p, m: F.concat(F.lit(p), (n % m).cast("string"))
    adset = F.struct(
        tag("s", 200).alias("id"), tag("Set ", 200).alias("name"), F.lit("LOWEST").alias("bid_strategy"),
        F.when(n % 3 == 0, "10").alias("bid_amount"), F.when(n % 3 == 1, "20").otherwise("").alias("daily_budget"),
        F.lit("30").alias("lifetime_budget"),
    )
    item = F.struct(
        F.lit("ignored").alias("id"), F.concat(F.lit("Ad "), F.col("c_name")).alias("name"),
        F.struct(tag("c", 50).alias("id"), tag("Campaign ", 50).alias("name")).alias("campaign"),
        adset.alias("adset"), _creative("c_custkey").alias("creative"), F.col("c_mktsegment").alias("status"),
    )
    return table(spark, folder, "customer").select(
        F.concat(F.lit("a"), n.cast("string")).alias("object_id"), item.alias("item"), "c_custkey"
    )


@query("entity_rows", f"WITH {OBJECTS_SQL} SELECT * FROM objects")
def entity_rows(spark, folder):
    return enrich.page_names(unnest.entity_rows(objects(spark, folder)), page_table(spark, folder))


JOINED_SQL = f"""WITH {PAGES_SQL.replace(' % 500', '')}, {OBJECTS_SQL},
metrics AS (SELECT * EXCLUDE (o_orderkey) FROM pages_ WHERE CAST(spend AS DOUBLE) > 0),
cached AS (SELECT * REPLACE (concat('Old ', id) AS name) FROM objects o
           JOIN (SELECT concat('a', c_custkey) AS id, c_custkey FROM customer) k USING (id)
           WHERE c_custkey % 2 = 0 AND c_custkey % 3 <> 0),
fetched AS (SELECT o.* FROM objects o JOIN (SELECT concat('a', c_custkey) AS id, c_custkey FROM customer) k USING (id)
            WHERE c_custkey % 5 <> 0),
entities AS (SELECT * FROM fetched UNION ALL SELECT * EXCLUDE (c_custkey) FROM cached WHERE id NOT IN (SELECT id FROM fetched))
"""


def daily_parts(spark, folder):
    pages = insight_pages(spark, folder, ads_=None)
    obj = objects(spark, folder)
    names = page_table(spark, folder)
    n = F.col("c_custkey")
    old = enrich.page_names(unnest.entity_rows(obj.filter(n % 2 == 0)), names)
    # half of the objects are cached, every third of those too long ago
    age = (F.substring("id", 2, 20).cast("bigint") % 3 == 0)
    cache = old.withColumn("name", F.concat(F.lit("Old "), F.col("id"))).withColumn(
        "updated_at", F.when(age, F.lit("2024-01-29 00:00:00")).otherwise(F.lit("2024-01-30 12:00:00")).cast("timestamp")
    )
    return pages, obj.filter(n % 5 != 0).drop("c_custkey"), cache, names


@query(
    "daily_report_entities",
    JOINED_SQL + "SELECT * FROM entities WHERE id IN (SELECT ad_id FROM metrics)",
)
def daily_report_entities(spark, folder):
    """Entities of the two-phase report: fresh cache, overridden by what was fetched, limited to the metrics' ads."""
    pages, fetched, cache, names = daily_parts(spark, folder)
    return ads.daily_report(pages, fetched, cache, names, "ad", AS_OF)[1]


_REST = (
    "campaign_id, campaign_name, adset_id, adset_name, adset_bid_strategy, adset_bid_amount, creative_name, creative_id, "
    "creative_title, creative_body, actor_id, creative_thumbnail_url, creative_thumbnail_raw_url, creative_link, status, page_name"
)


@query(
    "insight_entity_join",
    JOINED_SQL + f"""SELECT m.account_id, m.account_name, coalesce(m.id, e.id) AS id, m.ad_id, m.spend, m.impressions, m.date_start, m.date_stop,
  e.name AS ad_name, {', '.join('e.' + c.strip() for c in _REST.split(','))}
FROM metrics m LEFT JOIN entities e ON e.id = m.ad_id""",
)
def insight_entity_join(spark, folder):
    pages, fetched, cache, names = daily_parts(spark, folder)
    metrics, entities = ads.daily_report(pages, fetched, cache, names, "ad", AS_OF)
    return ads.joined_daily_report(metrics, entities, "ad")


@query(
    "entities_to_fetch",
    JOINED_SQL + "SELECT DISTINCT ad_id AS id FROM metrics WHERE ad_id NOT IN (SELECT id FROM cached)",
)
def entities_to_fetch(spark, folder):
    pages, _, cache, _ = daily_parts(spark, folder)
    return ads.entities_to_fetch(spending(unnest.insight_rows(pages, "ad")), cache, "ad", AS_OF)


@query("total_spend", "SELECT CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total_spend FROM lineitem")
def total_spend(spark, folder):
    return ads.total(table(spark, folder, "lineitem").select(F.col("l_extendedprice").cast("string").alias("spend")), "spend")


# -- actions ---------------------------------------------------------------------------------

KINDS = ["A", "N", "R"]
LONG_SQL = """
long AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, e AS position,
  CASE e WHEN 0 THEN l_returnflag WHEN 1 THEN 'R' ELSE 'A' END AS action_type, l_quantity + e AS value
  FROM lineitem, (VALUES (0), (1), (2)) t(e) WHERE l_linenumber <> 7)"""
LINE_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def action_payloads(spark, folder):
    entries = ", ".join(
        f"named_struct('action_type', {kind}, 'value', CAST(l_quantity + {e} AS STRING))"
        for e, kind in enumerate(["l_returnflag", "'R'", "'A'"])
    )
    made = F.to_json(F.struct(F.expr(f"CASE WHEN l_linenumber <> 7 THEN array({entries}) END").alias("actions")))
    schema = T.StructType([T.StructField("actions", schemas.ACTIONS)])
    return spread(table(spark, folder, "lineitem")).select(*LINE_KEYS, F.from_json(made, schema).alias("p"))


def _first_sql(kind):
    hits = " ".join(f"WHEN {c} = '{kind}' THEN l_quantity + {e}" for e, c in enumerate(["l_returnflag", "'R'", "'A'"]))
    return f"CASE WHEN l_linenumber = 7 THEN 0.0 {hits} ELSE 0.0 END AS \"{kind}\""


FIRST_SQL = f"SELECT {', '.join(LINE_KEYS)}, {', '.join(_first_sql(k) for k in KINDS)} FROM lineitem"


@query("action_pivot_first_match", FIRST_SQL)
def action_pivot_first_match(spark, folder):
    """Metrics as columns, straight from the arrays."""
    metrics = [pivot.Metric.of(k, f"actions:{k}") for k in KINDS]
    return action_payloads(spark, folder).select(*LINE_KEYS, *pivot.metric_columns("p", metrics))


@query("action_long_rows", f"WITH {LONG_SQL} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, 'actions' AS parent, position, action_type, value FROM long")
def action_long_rows(spark, folder):
    return pivot.long_actions(action_payloads(spark, folder), LINE_KEYS, "p", ["actions"])


@query("action_long_pivot", FIRST_SQL + " WHERE l_linenumber <> 7")
def action_long_pivot(spark, folder):
    """The same metrics by way of the long form."""
    return pivot.pivot_actions(action_long_rows(spark, folder), LINE_KEYS, KINDS)


@query(
    "action_totals",
    f"""WITH {LONG_SQL} SELECT l_suppkey, {', '.join(f"sum(CASE WHEN action_type = '{k}' THEN value ELSE 0.0 END) AS \"{k}\"" for k in KINDS)}
FROM long GROUP BY 1""",
)
def action_totals(spark, folder):
    return pivot.sum_actions(action_long_rows(spark, folder), ["l_suppkey"], KINDS)


# -- shop reports ------------------------------------------------------------------------------

METRICS = ["cost", "orders", "gross_revenue"]

SHOP_SQL = """
campaigns AS (
  SELECT concat('c', s_suppkey) AS campaign_id, s_name AS campaign_name,
         CASE WHEN s_suppkey % 2 = 0 THEN 'ENABLE' ELSE 'DISABLE' END AS operation_status, 'NO_BID' AS bid_type,
         '2024-01-01' AS start_date, '2024-01-31' AS end_date, 'adv' AS advertiser_id, 'Advertiser' AS advertiser_name,
         'st' AS store_id, 'Store' AS store_name, s_suppkey
  FROM supplier WHERE s_nationkey <> 3
),
lines AS (
  SELECT concat('c', l_suppkey) AS campaign_id, concat('g', l_partkey) AS item_group_id,
         concat('i', l_orderkey, '_', l_linenumber) AS item_id, CAST(l_discount AS VARCHAR) AS cost, CAST(l_tax AS VARCHAR) AS orders,
         CAST(l_extendedprice AS VARCHAR) AS gross_revenue, strftime(l_shipdate, '%Y-%m-%d') AS stat_time_day,
         l_discount, l_tax, l_linenumber, l_orderkey
  FROM lineitem
),
catalog AS (
  SELECT concat('g', (p_partkey // 3) * 2) AS item_group_id, p_name AS title, p_type AS status,
         concat('https://img.example.com/', p_partkey) AS product_image_url, p_partkey AS seq
  FROM part QUALIFY row_number() OVER (PARTITION BY p_partkey // 3 ORDER BY p_partkey DESC) = 1
)"""


def shop_campaigns(spark, folder):
    n = F.col("s_suppkey")
    return table(spark, folder, "supplier").filter(F.col("s_nationkey") != 3).select(
        F.concat(F.lit("c"), n.cast("string")).alias("campaign_id"), F.col("s_name").alias("campaign_name"),
        F.when(n % 2 == 0, "ENABLE").otherwise("DISABLE").alias("operation_status"), F.lit("NO_BID").alias("bid_type"),
        F.lit("2024-01-01").alias("start_date"), F.lit("2024-01-31").alias("end_date"),
        F.lit("adv").alias("advertiser_id"), F.lit("Advertiser").alias("advertiser_name"),
        F.lit("st").alias("store_id"), F.lit("Store").alias("store_name"),
    )


def shop_lines(spark, folder):
    text = lambda c: F.col(c).cast("string")
    return spread(table(spark, folder, "lineitem")).select(
        F.concat(F.lit("c"), text("l_suppkey")).alias("campaign_id"),
        F.concat(F.lit("g"), text("l_partkey")).alias("item_group_id"),
        F.concat(F.lit("i"), text("l_orderkey"), F.lit("_"), text("l_linenumber")).alias("item_id"),
        text("l_discount").alias("cost"), text("l_tax").alias("orders"), text("l_extendedprice").alias("gross_revenue"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("stat_time_day"), "l_linenumber", "l_orderkey",
    )


def shop_catalog(spark, folder):
    """Three entries for every second product; the last one counts."""
    n = F.col("p_partkey")
    return table(spark, folder, "part").select(
        F.concat(F.lit("g"), (F.floor(n / 3) * 2).cast("string")).alias("item_group_id"), F.col("p_name").alias("title"),
        F.col("p_type").alias("status"), F.concat(F.lit("https://img.example.com/"), n.cast("string")).alias("product_image_url"),
        n.alias("seq"),
    )


def creative_texts(spark, folder):
    """Texts of the creatives of even orders."""
    lines = shop_lines(spark, folder).filter(F.col("l_orderkey") % 2 == 0)
    none = F.when(F.col("l_linenumber") % 2 == 0, "https://img.example.com/own").otherwise("")
    return lines.select(
        "campaign_id", "item_group_id", "item_id", F.concat(F.lit("Video "), F.col("item_id")).alias("title"),
        F.lit("acc").alias("tt_account_name"), F.lit("https://img.example.com/acc").alias("tt_account_profile_image_url"),
        none.alias("product_img"),
    )


@query(
    "shop_creative_report",
    f"""WITH {SHOP_SQL} SELECT c.start_date, c.end_date, c.advertiser_id, c.advertiser_name, c.store_id, c.store_name,
  l.campaign_id, c.campaign_name, c.operation_status, l.item_group_id, k.title AS product_name, k.status AS product_status,
  k.product_image_url, l.item_id, concat('https://www.tiktok.com/@user/video/', l.item_id) AS video_url,
  CASE WHEN m THEN concat('Video ', l.item_id) END AS title, CASE WHEN m THEN 'acc' END AS tt_account_name,
  CASE WHEN m THEN 'https://img.example.com/acc' END AS tt_account_profile_image_url,
  CASE WHEN m AND l_linenumber % 2 = 0 THEN 'https://img.example.com/own' ELSE k.product_image_url END AS product_img,
  cost, orders, gross_revenue
FROM (SELECT *, l_orderkey % 2 = 0 AS m FROM lines) l JOIN campaigns c USING (campaign_id) LEFT JOIN catalog k USING (item_group_id)
WHERE NOT (l_discount = 0 AND l_tax = 0)""",
)
def shop_creative_report(spark, folder):
    lines = shop_lines(spark, folder)
    products = lines.select("campaign_id", "item_group_id").distinct()
    creatives = lines.select("campaign_id", "item_group_id", "item_id", *METRICS)
    return shop.creative_report(
        shop_campaigns(spark, folder), products, creatives, shop_catalog(spark, folder), creative_texts(spark, folder), METRICS
    )


@query(
    "shop_product_report",
    f"""WITH {SHOP_SQL} SELECT c.start_date, c.end_date, c.advertiser_id, c.advertiser_name, c.store_id, c.store_name,
  l.campaign_id, c.campaign_name, c.operation_status, c.bid_type, l.item_group_id, l.stat_time_day,
  coalesce(k.title, concat('Không tìm thấy thông tin cho ID ', l.item_group_id)) AS product_name, k.product_image_url,
  k.status AS product_status, k.product_image_url AS product_img, cost, orders, gross_revenue
FROM lines l JOIN campaigns c USING (campaign_id) LEFT JOIN catalog k USING (item_group_id)""",
)
def shop_product_report(spark, folder):
    perf = shop_lines(spark, folder).select("campaign_id", "item_group_id", "stat_time_day", *METRICS)
    return shop.product_report(shop_campaigns(spark, folder), perf, shop_catalog(spark, folder), METRICS)


@query(
    "catalog_fallback",
    f"""WITH {SHOP_SQL} SELECT item_id, l.item_group_id, coalesce(title, concat('Không tìm thấy thông tin cho ID ', l.item_group_id)) AS product_title,
  status AS product_status, product_image_url FROM lines l LEFT JOIN catalog USING (item_group_id)""",
)
def catalog_fallback(spark, folder):
    perf = shop_lines(spark, folder).select("item_id", "item_group_id")
    return enrich.join_catalog(perf, shop_catalog(spark, folder), "item_group_id", "seq", note_missing=True)


@query("zero_metric_filter", "SELECT l_orderkey, l_linenumber, l_discount AS cost, l_tax AS orders FROM lineitem WHERE NOT (l_discount = 0 AND l_tax = 0)")
def zero_metric_filter(spark, folder):
    rows = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_discount").alias("cost"), F.col("l_tax").alias("orders")
    )
    return enrich.drop_idle(rows)


@query(
    "group_join_children",
    """SELECT o_orderkey, 0 AS segment, count(l_orderkey) AS children, CAST(coalesce(sum(CAST(l_quantity AS DECIMAL(18,2))), 0) AS DOUBLE) AS quantity,
  coalesce(string_agg(concat(l_linenumber, ':', l_partkey), ',' ORDER BY l_linenumber, l_partkey, l_suppkey) FILTER (l_orderkey IS NOT NULL), '') AS listed
FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1""",
)
def group_join_children(spark, folder):
    """Orders with the array of their line items; orders without any keep an empty one."""
    parents = table(spark, folder, "orders").select("o_orderkey")
    kids = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"
    )
    nested = enrich.nest_children(parents, kids, ["o_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey"], "items")
    total = F.aggregate("items", F.lit(0).cast("decimal(28,2)"), lambda a, i: (a + i["l_quantity"].cast("decimal(18,2)")).cast("decimal(28,2)"))
    return nested.select(
        "o_orderkey", "segment", F.size("items").cast("bigint").alias("children"), total.cast("double").alias("quantity"),
        F.array_join(F.transform("items", lambda i: F.concat(i["l_linenumber"].cast("string"), F.lit(":"), i["l_partkey"].cast("string"))), ",").alias("listed"),
    )


@query(
    "attach_children_flat",
    "SELECT o_orderkey, o_custkey, l_linenumber, l_partkey, l_quantity FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey",
)
def attach_children_flat(spark, folder):
    """The same pairing without arrays."""
    kids = table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_partkey", "l_quantity")
    return enrich.attach_children(table(spark, folder, "orders").select("o_orderkey", "o_custkey"), kids, ["o_orderkey"])


def nested_reports(spark, folder):
    """Each line item as a campaign document with two products of up to three creatives."""
    text = lambda c: F.col(c).cast("string")

    def creative(i, cost):
        return F.struct(
            F.concat(text("l_orderkey"), F.lit(f"_{i}")).alias("item_id"),
            F.create_map(F.lit("cost"), cost, F.lit("orders"), text("l_tax")).alias("metrics"),
            F.struct(
                F.concat(F.lit("T"), text("l_linenumber")).alias("title"), F.lit(None).cast("string").alias("tt_account_name"),
                F.lit(None).cast("string").alias("tt_account_profile_image_url"), F.lit("").alias("product_img"),
            ).alias("metadata"),
        )

    def product(i, creatives):
        return F.struct(
            F.struct(
                text("l_suppkey").alias("campaign_id"), F.concat(text("l_partkey"), F.lit(f"_{i}")).alias("item_group_id"),
                F.lit(None).cast("string").alias("stat_time_day"),
            ).alias("dimensions"),
            F.create_map(F.lit("cost"), text("l_discount")).alias("metrics"),
            F.struct(
                F.lit("P").alias("product_title"), F.lit("S").alias("product_status"), F.lit("img").alias("product_image_url")
            ).alias("product_details"),
            creatives.alias("creative_details"),
        )

    two = F.array(creative(0, text("l_discount")), creative(1, F.lit("0")))
    none = F.array().cast(T.ArrayType(schemas.CREATIVE))
    second = F.when(F.col("l_linenumber") % 2 == 0, F.array(creative(2, F.lit("1.5")))).otherwise(none)
    docs = F.when(F.col("l_linenumber") != 5, F.array(product(0, two), product(1, second)))
    return as_table(spread(table(spark, folder, "lineitem")).select(
        F.col("l_shipdate").cast("date").cast("string").alias("start_date"), text("l_suppkey").alias("campaign_id"),
        F.col("l_returnflag").alias("campaign_name"), F.col("l_linestatus").alias("operation_status"), docs.alias("performance_data"),
    ))


NESTED_SQL = """
creatives AS (
  SELECT strftime(l_shipdate, '%Y-%m-%d') AS start_date, CAST(l_suppkey AS VARCHAR) AS campaign_id, l_returnflag AS campaign_name,
         l_linestatus AS operation_status, concat(l_partkey, '_', e // 2) AS item_group_id, 'P' AS product_name, 'S' AS product_status,
         'img' AS product_image_url, concat(l_orderkey, '_', e) AS item_id,
         concat('https://www.tiktok.com/@user/video/', l_orderkey, '_', e) AS video_url, concat('T', l_linenumber) AS title,
         NULL::VARCHAR AS tt_account_name, NULL::VARCHAR AS tt_account_profile_image_url, 'img' AS product_img,
         CASE e WHEN 0 THEN CAST(l_discount AS VARCHAR) WHEN 1 THEN '0' ELSE '1.5' END AS cost, CAST(l_tax AS VARCHAR) AS orders
  FROM lineitem, (VALUES (0), (1), (2)) t(e)
  WHERE l_linenumber <> 5 AND (e < 2 OR l_linenumber % 2 = 0)
)"""


@query("nested_flatten", f"WITH {NESTED_SQL} SELECT * FROM creatives")
def nested_flatten(spark, folder):
    return unnest.flatten_creatives(nested_reports(spark, folder), ["cost", "orders"])


@query(
    "nested_zero_filter",
    f"WITH {NESTED_SQL} SELECT * FROM creatives WHERE NOT (CAST(cost AS DOUBLE) = 0 AND CAST(orders AS DOUBLE) = 0)",
)
def nested_zero_filter(spark, folder):
    """Idle creatives dropped inside the documents, before they are unfolded."""
    docs = enrich.drop_idle_nested(nested_reports(spark, folder), "performance_data", "creative_details")
    return unnest.flatten_creatives(docs, ["cost", "orders"])


@query(
    "account_refs",
    "SELECT concat('act_', c_custkey) AS account_id, CASE WHEN c_custkey % 2 = 0 THEN concat('Account act_', c_custkey) ELSE c_name END AS account_name FROM customer",
)
def account_refs(spark, folder):
    ident = F.concat(F.lit("act_"), F.col("c_custkey").cast("string"))
    obj = F.to_json(F.struct(ident.alias("id"), F.col("c_name").alias("name")))
    given = table(spark, folder, "customer").select(F.when(F.col("c_custkey") % 2 == 0, ident).otherwise(obj).alias("account"))
    return unnest.account_refs(given)

