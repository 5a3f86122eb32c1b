"""Request planning: date chunks, cache splits, id sets and request URLs."""

from __future__ import annotations

from pyspark.sql import functions as F

from adlake.functions import dates as dt
from adlake.functions import text as tx
from adlake.functions.jsonx import number
from adlake.operators import chunks, sets
from adlake.plans import templates
from adlake.workload.derive import table
from adlake.workload.registry import query

SPAN_SQL = """
span AS (SELECT o_custkey AS account, CAST(min(o_orderdate) AS DATE) AS s, CAST(max(o_orderdate) AS DATE) AS e FROM orders GROUP BY 1)"""


def spans(spark, folder):
    """First and last order day per customer: one date range per account."""
    day = F.col("o_orderdate").cast("date")
    return table(spark, folder, "orders").groupBy(F.col("o_custkey").alias("account")).agg(F.min(day).alias("s"), F.max(day).alias("e"))


MONTHS_SQL = f"""WITH {SPAN_SQL}, m AS (
  SELECT account, s, e, CAST(unnest(generate_series(date_trunc('month', s), e, INTERVAL 1 MONTH)) AS DATE) AS m FROM span)
SELECT account, greatest(m, s) AS "start", least(last_day(m), e) AS "end" FROM m"""


@query("month_chunks", MONTHS_SQL)
def month_chunks(spark, folder):
    return chunks.explode_ranges(spans(spark, folder), dt.month_ranges(F.col("s"), F.col("e"))).drop("s", "e")


@query(
    "week_chunks",
    f"""WITH {SPAN_SQL}, w AS (SELECT account, e, CAST(unnest(generate_series(s, e, INTERVAL 7 DAY)) AS DATE) AS d FROM span)
SELECT account, d AS "start", least(d + 6, e) AS "end" FROM w""",
)
def week_chunks(spark, folder):
    return chunks.explode_ranges(spans(spark, folder), dt.week_ranges(F.col("s"), F.col("e"))).drop("s", "e")


@query(
    "factor_chunks",
    f"""WITH chunk AS ({MONTHS_SQL}),
step AS (SELECT account, "start" AS s, "end" AS e, CAST(ceil(("end" - "start" + 1) / 3.0) AS INTEGER) AS n FROM chunk),
p AS (SELECT *, unnest(generate_series(0, CAST(e - s AS INTEGER), n)) AS o FROM step)
SELECT account, s + CAST(o AS INTEGER) AS "start", least(s + CAST(o AS INTEGER) + n - 1, e) AS "end" FROM p""",
)
def factor_chunks(spark, folder):
    return chunks.explode_ranges(spans(spark, folder), dt.split_months(F.col("s"), F.col("e"), 3)).drop("s", "e")


@query(
    "halve_range",
    f"""WITH {SPAN_SQL}, step AS (SELECT *, greatest(1, (e - s + 1) // 2) AS n FROM span),
p AS (SELECT *, unnest(generate_series(0, CAST(e - s AS BIGINT), n)) AS o FROM step)
SELECT account, s + CAST(o AS INTEGER) AS "start", least(s + CAST(o + n - 1 AS INTEGER), e) AS "end" FROM p""",
)
def halve_range(spark, folder):
    return chunks.explode_ranges(spans(spark, folder), dt.reduced_ranges(F.col("s"), F.col("e"))).drop("s", "e")


@query(
    "cross_plan",
    """SELECT c_custkey AS account, m AS "start", least(last_day(m), DATE '2025-03-05') AS "end"
FROM customer, (VALUES (DATE '2025-01-15'), (DATE '2025-02-01'), (DATE '2025-03-01')) t(m)""",
)
def cross_plan(spark, folder):
    """Every account with every monthly chunk. The chunks are unfolded per account, so there is no join."""
    accounts = table(spark, folder, "customer").select(F.col("c_custkey").alias("account"))
    day = lambda d: F.lit(d).cast("date")
    return chunks.explode_ranges(accounts, dt.month_ranges(day("2025-01-15"), day("2025-03-05")))


@query(
    "full_month_flag",
    f"""WITH chunk AS ({MONTHS_SQL}) SELECT account, "start", "end",
  day("start") = 1 AND "end" = last_day("start") AS strict_month,
  day("start") = 1 AND "end" = last_day("end") AS loose_month FROM chunk""",
)
def full_month_flag(spark, folder):
    s, e = F.col("start"), F.col("end")
    return month_chunks(spark, folder).select(
        "account", "start", "end",
        dt.is_full_month(s, e).alias("strict_month"), dt.is_full_month(s, e, strict=False).alias("loose_month"),
    )


CACHE_SQL = """
cache AS (SELECT DISTINCT o_custkey AS account, CAST(date_trunc('month', o_orderdate) AS DATE) AS "start",
          last_day(o_orderdate) AS "end" FROM orders WHERE o_orderstatus = 'F')"""


def month_cache(spark, folder):
    """Whole months with a finished order count as cached."""
    o = table(spark, folder, "orders").filter(F.col("o_orderstatus") == "F")
    return o.select(
        F.col("o_custkey").alias("account"), F.trunc("o_orderdate", "MM").alias("start"),
        F.last_day("o_orderdate").alias("end"), F.col("o_totalprice").alias("amount"),
    )


@query(
    "cache_hit_miss",
    f"""WITH chunk AS ({MONTHS_SQL}), {CACHE_SQL}
SELECT k.account, k."start", k."end", CASE WHEN c.account IS NOT NULL AND NOT (DATE '1998-06-10' BETWEEN k."start" AND k."end")
  THEN 'cached' ELSE 'fetch' END AS source
FROM chunk k LEFT JOIN cache c ON c.account = k.account AND c."start" = k."start" AND c."end" = k."end" """,
)
def cache_hit_miss(spark, folder):
    return chunks.split_by_cache(month_chunks(spark, folder), month_cache(spark, folder), ["account"], "1998-06-10")


@query(
    "cached_rows",
    f"""WITH chunk AS ({MONTHS_SQL}), used AS (SELECT * FROM chunk WHERE NOT (DATE '1998-06-10' BETWEEN "start" AND "end"))
SELECT o_custkey AS account, u."start", u."end", o_totalprice AS amount FROM orders
JOIN used u ON u.account = o_custkey AND u."start" = CAST(date_trunc('month', o_orderdate) AS DATE) AND u."end" = last_day(o_orderdate)
WHERE o_orderstatus = 'F'""",
)
def cached_rows(spark, folder):
    return chunks.cached_rows(month_chunks(spark, folder), month_cache(spark, folder), ["account"], "1998-06-10")


@query(
    "semi_batch",
    "SELECT o_orderkey, o_custkey FROM orders WHERE EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_mktsegment = 'BUILDING')",
)
def semi_batch(spark, folder):
    batch = table(spark, folder, "customer").filter(F.col("c_mktsegment") == "BUILDING").select(F.col("c_custkey").alias("o_custkey"))
    return sets.only_known(table(spark, folder, "orders").select("o_orderkey", "o_custkey"), batch, ["o_custkey"])


@query(
    "missing_ids",
    "SELECT c_custkey AS id FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')",
)
def missing_ids(spark, folder):
    wanted = sets.distinct_ids(table(spark, folder, "customer").select(F.col("c_custkey").alias("id")), "id")
    have = table(spark, folder, "orders").filter(F.col("o_orderstatus") == "F").select(F.col("o_custkey").alias("id"))
    return sets.missing_ids(wanted, have, ["id"])


@query(
    "concat_waves",
    "SELECT o_orderkey AS id, o_orderstatus AS status, NULL::DOUBLE AS amount FROM orders WHERE o_orderstatus = 'F' "
    "UNION ALL SELECT o_orderkey, NULL, o_totalprice FROM orders WHERE o_orderstatus <> 'F'",
)
def concat_waves(spark, folder):
    """Waves with different columns put together."""
    o = table(spark, folder, "orders")
    one = o.filter(F.col("o_orderstatus") == "F").select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"))
    two = o.filter(F.col("o_orderstatus") != "F").select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("amount"))
    return sets.concat(one, two)


@query(
    "spend_and_status_filters",
    """SELECT c_custkey, spend, status FROM (SELECT c_custkey, CAST(c_acctbal AS VARCHAR) AS spend, c_acctbal,
  ['ACTIVE','DELETED','PAUSED','DISAPPROVED'][c_custkey % 4 + 1] AS status FROM customer)
WHERE c_acctbal > 0 AND status IN ('ACTIVE', 'PAUSED')""",
)
def spend_and_status_filters(spark, folder):
    states = F.array(*[F.lit(s) for s in ("ACTIVE", "DELETED", "PAUSED", "DISAPPROVED")])
    rows = table(spark, folder, "customer").select(
        "c_custkey", F.col("c_acctbal").cast("string").alias("spend"),
        F.get(states, (F.col("c_custkey") % 4).cast("int")).alias("status"),
    )
    return templates.reportable(templates.spending(rows), "adset", F.col("status"))


@query(
    "template_projection",
    "SELECT o_custkey AS account_id, o_orderkey AS campaign_id, o_orderdate AS date_start, o_totalprice AS spend FROM orders",
)
def template_projection(spark, folder):
    """An insight request's field set picks the columns; names the data lacks are left out."""
    rows = table(spark, folder, "orders").withColumnsRenamed(
        {"o_custkey": "account_id", "o_orderkey": "campaign_id", "o_orderdate": "date_start", "o_totalprice": "spend"}
    )
    return templates.project(rows, templates.insight_fields("campaign", ["spend", "clicks"], ["spend"]))


@query(
    "json_scalar_defaults",
    """SELECT event_id, coalesce(try_cast(json_extract_string(props, '$.k') AS DOUBLE), 0.0) AS k, 0.0::DOUBLE AS missing FROM events""",
)
def json_scalar_defaults(spark, folder):
    p = F.from_json("props", "k string, absent string")
    return table(spark, folder, "events").select("event_id", p.alias("p")).select(
        "event_id", number(F.col("p.k")).alias("k"), number(F.col("p.absent")).cast("double").alias("missing")
    )


@query("name_sanitise", "SELECT p_partkey, regexp_replace(lower(p_name), '[^a-zA-Z0-9_]', '_', 'g') AS table_name FROM part")
def name_sanitise(spark, folder):
    return table(spark, folder, "part").select("p_partkey", tx.sanitise(F.col("p_name")).alias("table_name"))


# -- URLs ------------------------------------------------------------------------------

# the page's URL without its fragment, as an API request with a secret and a cursor
_BARE = "regexp_replace(url, '#.*$', '')"
REQUEST_SQL = f"""
req AS (SELECT page_id, concat({_BARE}, CASE WHEN {_BARE} LIKE '%?%' THEN '&' ELSE '?' END, 'access_token=tok', page_id,
  '&before=b', page_id, '&q=a%20b') AS request FROM pages)"""


def requests(spark, folder):
    bare = F.regexp_replace("url", "#.*$", "")
    sep = F.when(bare.contains("?"), "&").otherwise("?")
    n = F.col("page_id").cast("string")
    return table(spark, folder, "pages").select(
        "page_id",
        F.concat(bare, sep, F.lit("access_token=tok"), n, F.lit("&before=b"), n, F.lit("&q=a%20b")).alias("request"),
    )


@query(
    "url_redact",
    f"""WITH {REQUEST_SQL} SELECT page_id,
  replace(regexp_replace(regexp_replace(request, '^[a-z]+://[^/]*/*', ''), 'access_token=[^&]*&', ''), '%20', '+') AS relative FROM req""",
)
def url_redact(spark, folder):
    return requests(spark, folder).select("page_id", tx.relative_url(F.col("request")).alias("relative"))


@query(
    "url_after_cursor",
    f"""WITH {REQUEST_SQL} SELECT page_id, CASE WHEN page_id % 5 = 0 THEN concat('https://next.example.com/', page_id)
  WHEN page_id % 5 = 1 THEN NULL
  ELSE concat(replace(regexp_replace(request, '&before=[^&]*', ''), '%20', '+'), '&after=c', page_id) END AS next_url FROM req""",
)
def url_after_cursor(spark, folder):
    n = F.col("page_id")
    nxt = F.when(n % 5 == 0, F.concat(F.lit("https://next.example.com/"), n.cast("string")))
    after = F.when(n % 5 != 1, F.concat(F.lit("c"), n.cast("string")))
    return requests(spark, folder).select("page_id", tx.next_page_url(nxt, after, F.col("request")).alias("next_url"))


@query(
    "url_time_range",
    "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS since, CAST(o_orderdate AS DATE) + 30 AS until FROM orders",
)
def url_time_range(spark, folder):
    """Date range out of request URLs, plain and percent-encoded."""
    s = F.date_format("o_orderdate", "yyyy-MM-dd")
    u = F.date_format(F.date_add(F.col("o_orderdate").cast("date"), 30), "yyyy-MM-dd")
    plain = F.concat(F.lit('act_1/insights?level=ad&time_range={"since": "'), s, F.lit('", "until": "'), u, F.lit('"}&limit=500'))
    coded = F.concat(
        F.lit("act_1/insights?level=ad&time_range="),
        F.url_encode(F.concat(F.lit('{"since": "'), s, F.lit('", "until": "'), u, F.lit('"}'))), F.lit("&limit=500"),
    )
    url = F.when(F.col("o_orderkey") % 2 == 0, plain).otherwise(coded)
    return table(spark, folder, "orders").select(
        "o_orderkey", tx.url_since(url).alias("since"), tx.url_until(url).alias("until")
    )


@query(
    "endpoint_names",
    "SELECT page_id, regexp_replace(CASE WHEN page_id % 2 = 0 THEN concat('gmv/', page_id, '/') ELSE url END, '/$', '') AS endpoint FROM pages",
)
def endpoint_names(spark, folder):
    n = F.col("page_id")
    full = F.concat(F.lit("https://business-api.tiktok.com/open_api/v1.3/gmv/"), n.cast("string"), F.lit("/"))
    url = F.when(n % 2 == 0, full).otherwise(F.col("url"))
    return table(spark, folder, "pages").select("page_id", tx.endpoint_name(url).alias("endpoint"))
