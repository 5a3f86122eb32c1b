import collections
import datetime as dt
import random

import pytest
from conftest import ts
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlake import schemas
from adlake.operators import chunks, enrich, joblog, latest, pivot, sets, unnest, usage, windows
from adlake.plans import ads, dashboards, shop, templates
from adlake.plans.registry import ReportRegistry, default_registry
from adlake.sources import files
from adlake.sources.tables import cache_rows

START = dt.datetime(2025, 1, 1)


def call_log(n, keys, seconds, seed):
    """Calls of which one key makes about a third."""
    rnd = random.Random(seed)
    picks = [keys[0]] * (n // 3) + [rnd.choice(keys) for _ in range(n - n // 3)]
    return [(i, k, START + dt.timedelta(microseconds=rnd.randrange(seconds * 1_000_000))) for i, k in enumerate(picks)]


def test_sliding_count(spark):
    calls = call_log(900, ["hot", "b", "c"], 600, 1)
    calls += [(10_000, "edge", START), (10_001, "edge", START + dt.timedelta(seconds=20)), (10_002, "edge", START + dt.timedelta(seconds=39, microseconds=999_999))]
    df = spark.createDataFrame(calls, "id int, k string, t timestamp")
    got = {r["id"]: r["in_window"] for r in windows.sliding_count(df, "k", "t", 20, slice_factor=3).collect()}
    span = dt.timedelta(seconds=20)
    want = {i: sum(k2 == k and t - span < t2 <= t for _, k2, t2 in calls) for i, k, t in calls}
    assert got == want


def test_fixed_quota(spark):
    calls = call_log(600, ["hot", "b"], 300, 2)
    df = spark.createDataFrame(calls, "id int, k string, t timestamp")
    got = {r["id"]: r["allowed"] for r in windows.fixed_quota(df, "k", "t", ["id"], [(45, 60), (2, 1)]).collect()}
    used, want = collections.Counter(), {}
    for i, k, t in sorted(calls, key=lambda c: (c[2], c[0])):
        us, ok = int((t - START).total_seconds() * 1e6), True
        for limit, period in ((2, 1), (45, 60)):
            slot = (k, period, us // (period * 1_000_000))
            used[slot] += 1
            if used[slot] > limit:
                ok = False
                break
        want[i] = ok
    assert got == want and 0 < sum(want.values()) < len(want)


def test_pending_wait(spark):
    now = START + dt.timedelta(seconds=30)
    df = spark.createDataFrame([("a", START + dt.timedelta(seconds=s)) for s in range(30)] + [("b", START + dt.timedelta(seconds=25))], "k string, t timestamp")
    got = {r["k"]: (r["recent"], r["wait_seconds"]) for r in windows.pending_wait(df, "k", "t", now, adding=5, limit=20).collect()}
    # 19 calls are younger than 20 s; 4 of them must age out, the fourth oldest is 16 s old
    assert got == {"a": (19, 4.0), "b": (1, 0.0)}


def test_dense_hours(spark):
    df = spark.createDataFrame([("e", ts("2025-01-01 10:15:00")), ("e", ts("2025-01-01 10:45:00")), ("f", ts("2024-12-30 00:00:00"))], "endpoint string, ts timestamp")
    series = windows.dense_hours(windows.counts_by_hour(df, "endpoint", "ts"), "2025-01-01 12:30:00", hours=4).orderBy("endpoint", "hour")
    assert [(r["endpoint"], r["hour"].hour, r["calls"]) for r in series.collect()] == [
        ("e", 9, 0), ("e", 10, 2), ("e", 11, 0), ("e", 12, 0), ("f", 9, 0), ("f", 10, 0), ("f", 11, 0), ("f", 12, 0),
    ]


def test_batches_are_full_and_unique(spark):
    ids = spark.range(1003).select(F.concat(F.lit("id"), F.col("id").cast("string")).alias("id"))
    got = collections.Counter(r["batch_id"] for r in sets.with_batch(ids, "id", 20, buckets=16).collect())
    assert got == {i: (20 if i < 50 else 3) for i in range(51)}


def test_nest_children_splits_hot_parents_without_loss(spark):
    parents = spark.createDataFrame([("hot",), ("few",), ("none",), (None,)], "k string")
    kids = spark.createDataFrame([("hot", i) for i in range(300)] + [("few", 2), ("few", 1), (None, 9), ("", 8)], "k string, n int")
    out = enrich.nest_children(parents, kids, ["k"], ["n"], "items", per_row=50).collect()
    by = collections.defaultdict(list)
    for r in out:
        by[r["k"]].append([i["n"] for i in r["items"]])
    assert by["none"] == [[]] and by[None] == [[]] and by["few"] == [[1, 2]]
    assert len(by["hot"]) > 1 and sorted(x for part in by["hot"] for x in part) == list(range(300))
    assert all(part == sorted(part) for part in by["hot"])


def test_latest_helpers(spark, rows):
    frame = lambda *r: spark.createDataFrame(list(r), "id string, v int, note string")
    df = frame(("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z"), ("", 9, "skip"), (None, 9, "skip"))
    assert [r["note"] for r in rows(latest.last_wins(df, ["id"], "v"), "id")] == ["y", "z"]
    new = frame(("a", 0, "new"), ("c", 0, "new"))
    assert [(r["id"], r["note"]) for r in rows(latest.override(frame(("a", 5, "old"), ("b", 5, "old")), new, ["id"]), "id")] == [
        ("a", "new"), ("b", "old"), ("c", "new"),
    ]
    plan = latest.latest_per_key(df, ["id"], "v")._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_newer_than(spark):
    df = spark.createDataFrame([(ts("2025-01-01"),), (ts("2025-01-02"),)], "created_at timestamp")
    count = lambda *a, **k: latest.newer_than(df, *a, **k).count()
    assert (count(None), count("2025-01-01"), count("2025-01-01", inclusive=True)) == (2, 1, 2)


# -- nested reports --------------------------------------------------------------------------


def test_performance_rows(spark, rows):
    item = T.StructType([
        *schemas.texts("id", "name", "spend").fields, T.StructField("campaign", schemas.NAMED), T.StructField("adset", schemas.NAMED),
        T.StructField("creative", schemas.ENTITY["creative"].dataType),
        T.StructField("insights", T.StructType([T.StructField("data", T.ArrayType(schemas.texts("spend", "clicks")))])),
    ])
    schema = T.StructType([*schemas.texts("account_id", "account_name", "start_date", "end_date").fields, T.StructField("data", T.ArrayType(item))])
    full = {"id": "a1", "name": "n", "spend": "0", "campaign": {"id": "c", "name": "C"}, "adset": None,
            "creative": {"id": "cr", "actor_id": "7", "thumbnail_url": "u", "object_story_id": "s"}, "insights": {"data": [{"spend": "5", "clicks": "1"}]}}
    bare = {"id": "a2", "name": "m", "spend": "0"}
    pages = spark.createDataFrame([("act", "A", "s", "e", [full, bare]), ("act", "A", "s", "e", None)], schema)
    names = spark.createDataFrame([("7", "Page 7")], "page_id string, page_name string")
    one, two = rows(ads.performance_report(pages, names, "ad"), "id")
    assert (one["spend"], one["clicks"], one["campaign_name"], one["page_name"], one["creative_link"], one["creative_title"]) == (
        "5", "1", "C", "Page 7", "https://facebook.com/s", "")
    assert (two["spend"], two["clicks"], two["creative_id"], two["page_name"], two["adset_id"]) == ("0", None, None, None, None)
    camp = rows(unnest.performance_rows(pages, "campaign"), "id")
    assert [(r["campaign_id"], r["campaign_name"]) for r in camp] == [("a1", "n"), ("a2", "m")]


def test_join_entities(spark, rows):
    insights = spark.createDataFrame([("a1", "5", "own"), ("a2", "6", None), (None, "7", None)], "ad_id string, spend string, status string")
    entities = spark.createDataFrame([("a1", "Ad 1", "meta", "x")], "id string, name string, status string, extra string")
    got = rows(enrich.join_entities(insights, entities, "ad"), "spend")
    assert got == [
        {"ad_id": "a1", "spend": "5", "status": "own", "extra": "x", "ad_name": "Ad 1"},
        {"ad_id": "a2", "spend": "6", "status": None, "extra": None, "ad_name": None},
        {"ad_id": None, "spend": "7", "status": None, "extra": None, "ad_name": None},
    ]


def test_shop_reports(spark, rows):
    campaigns = spark.createDataFrame([("c1", "C", "ENABLE", "B", "s", "e")], "campaign_id string, campaign_name string, operation_status string, bid_type string, start_date string, end_date string")
    lines = spark.createDataFrame([("c1", "g1", "i1", "d", "0", "0"), ("c1", "g1", "i2", "d", "1", "0"), ("c1", "g2", "i3", "d", "0", "2"), ("zz", "g1", "i4", "d", "9", "9")],
                                  "campaign_id string, item_group_id string, item_id string, stat_time_day string, cost string, orders string")
    catalog = spark.createDataFrame([("g1", "old", "S", "u0", 1), ("g1", "new", "S", "u", 2)], "item_group_id string, title string, status string, product_image_url string, seq int")
    meta = spark.createDataFrame([("c1", "g1", "i2", "T", "acc", "p", "")], "campaign_id string, item_group_id string, item_id string, title string, tt_account_name string, tt_account_profile_image_url string, product_img string")
    products = lines.select("campaign_id", "item_group_id").distinct()
    out = rows(shop.creative_report(campaigns, products, lines.drop("stat_time_day"), catalog, meta, ["cost", "orders"]), "item_id")
    assert [(r["item_id"], r["product_name"], r["title"], r["product_img"]) for r in out] == [("i2", "new", "T", "u"), ("i3", None, None, None)]
    prod = rows(shop.product_report(campaigns, lines.drop("item_id"), catalog, ["cost"]), "cost", "item_group_id")
    assert [r["product_name"] for r in prod] == ["new", "Không tìm thấy thông tin cho ID g2", "new"]


def test_header_map_and_accounts(spark):
    heads = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(v).alias("value")) for n, v in (("X-A", "1"), ("b", "2"), ("x-a", "3"))])
    df = spark.range(1).select(unnest.header_map(heads).alias("m"), unnest.header_value(heads, "x-a").alias("v"))
    assert df.first()["m"] == {"x-a": "3", "b": "2"} and df.first()["v"] == "3"


def test_metric_expansion_wins(spark):
    df = spark.createDataFrame([("own", {"cost": "5"})], "cost string, metrics map<string,string>")
    assert unnest.expand_metrics(df, "metrics", ["cost", "roi"]).first().asDict() == {"cost": "5", "roi": None}


def test_long_form_agrees_with_columns(spark, rows):
    data = [("1", [("a", "1"), ("b", "2"), ("a", "3")]), ("2", [("b", "x")]), ("3", None)]
    df = spark.createDataFrame([(k, (v,)) for k, v in data], T.StructType([T.StructField("k", T.StringType()), T.StructField("p", T.StructType([T.StructField("actions", schemas.ACTIONS)]))]))
    wide = df.select("k", *pivot.metric_columns("p", [pivot.Metric.of(x, f"actions:{x}") for x in "ab"]))
    long = pivot.pivot_actions(pivot.long_actions(df, ["k"], "p", ["actions"]), ["k"], ["a", "b"])
    assert [r for r in rows(wide, "k") if r["k"] != "3"] == rows(long, "k") == [{"k": "1", "a": 1.0, "b": 2.0}, {"k": "2", "a": 0.0, "b": 0.0}]


# -- jobs ------------------------------------------------------------------------------------


def test_lifecycle(spark, rows):
    ev = [
        ("done", "end", "2025-01-01 00:01:40.126", "SUCCESS", None, "ok"), ("done", "start", "2025-01-01 00:00:00", None, None, None),
        ("done", "progress", "2025-01-01 00:02:00", "RUNNING", 90, "late"), ("run", "start", "2025-01-01 00:00:00", None, None, None),
        ("run", "progress", "2025-01-01 00:00:05", "RUNNING", 20, "step"), ("cut", "start", "2025-01-01 00:00:00", None, None, None),
        ("cut", "end", "2025-01-01 00:00:01", "SUCCESS", None, "TaskCancelledException()"), ("lost", "end", "2025-01-01 00:00:01", None, None, "boom"),
    ]
    df = spark.createDataFrame([(j, k, ts(t), s, p, m) for j, k, t, s, p, m in ev], "job_id string, kind string, ts timestamp, status string, progress int, message string")
    got = {r["job_id"]: (r["status"], r["duration_seconds"], r["message"], r["progress"]) for r in rows(joblog.lifecycle(df))}
    assert got == {
        "done": ("SUCCESS", 100.13, "ok", 90), "run": ("RUNNING", None, None, 20),
        "cut": ("CANCELLED", 1.0, "Task was cancelled by user.", None), "lost": ("FAILED", -1.0, "boom", None),
    }


def jobs(spark):
    mk = lambda i, **k: {"job_id": f"j{i}", "task_type": None, "user_email": None, "status": None, "start_time": START, "duration_seconds": None, "api_total_counts": None, **k}
    usage_ = {"summaries": [{"success_count": 1, "error_count": 0, "rate_limits": {"app_usage_pct": 96.0, "account_details": [
        {"account_id": "act_1", "insights_usage_pct": 5.0, "eta_seconds": 3, "business_use_cases": [{"type": "ads_insights", "total_cputime": 4, "total_time": 6, "ads_api_access_tier": "std"}]}]}},
        {"success_count": 0, "error_count": 0, "rate_limits": {"app_usage_pct": 75.0}}], "batch_count": 2, "total_backoff_sec": 7}
    data = [
        mk(1, task_type="facebook_daily", status="SUCCESS", user_email="a@x", duration_seconds=10.0, api_total_counts=usage_),
        mk(2, task_type="fb_breakdown", status="failed", user_email="nobody", duration_seconds=-1.0),
        mk(3, task_type="product", status="FAILED"), mk(4, status="PENDING", start_time=START - dt.timedelta(days=10)),
    ]
    return spark.createDataFrame(data, schemas.JOB_LOG)


def test_dashboards(spark, rows):
    j = jobs(spark)
    o = dashboards.overview(j, "all", START)
    assert rows(o["kpis"])[0] == {"total_tasks": 4, "successful_tasks": 1, "success_rate": 25.0, "avg_duration": 10.0, "unique_users": 1}
    assert rows(o["top_failed_users"]) == [{"user_email": "Unknown", "n": 1}]
    assert joblog.kpis(j.limit(0)).first().asDict() == {"total_tasks": 0, "successful_tasks": 0, "success_rate": 0.0, "avg_duration": 0.0, "unique_users": 0}
    assert joblog.in_range(j, "24h", START).count() == 3
    a = dashboards.ads(j, "all", START)
    assert rows(a["totals"])[0] == {"total_tasks": 2, "total_batches": 2, "success_batches": 1, "total_backoff": 7}
    assert {r["bucket"]: r["n"] for r in rows(a["usage"])} == {"Safe (<75%)": 0, "Warning (75-95%)": 1, "Critical (>95%)": 1}
    assert {r["status_group"]: r["n"] for r in rows(a["by_status"])} == {"Success": 1, "Failed": 1, "Cancelled": 0, "Started": 0}
    calls = spark.createDataFrame([("https://business-api.tiktok.com/open_api/v1.3/gmv/", START), ("https://other/", START)], "endpoint string, ts timestamp")
    s = dashboards.shop(j, calls, "all", START, hours=2)
    assert rows(s["api_totals"]) == [{"endpoint": "gmv", "total": 1}] and rows(s["totals"])[0]["product_tasks"] == 1
    d = dashboards.job_detail(j)
    assert rows(d["accounts"])[0] == {"job_id": "j1", "account_id": "act_1", "max_insights": 5.0, "max_eta": 3, "call_count": 1, "tier": "std"}
    assert [(r["batch_index"], r["insights_usage"], r["cpu_time"]) for r in rows(d["series"], "batch_index")] == [(0, 5.0, 4), (1, 0.0, 0)]
    assert [r["max_cpu"] for r in rows(d["batches"], "batch_index")] == [4, 0]
    assert {r["endpoint"] for r in dashboards.combined(j, calls, "7d", START)["api_total_counts"].collect()} == {"https://other/", "https://business-api.tiktok.com/open_api/v1.3/gmv/"}
    assert joblog.job_log(j, "nope").first()[0] == "Log not found." and joblog.job_log(j, "j1").first()[0] == ""


def test_cache_split(spark, rows):
    month = lambda s, e: (1, dt.date.fromisoformat(s), dt.date.fromisoformat(e))
    plan = spark.createDataFrame([month("2025-01-01", "2025-01-31"), month("2025-02-01", "2025-02-28"), month("2025-03-01", "2025-03-31")], "k int, start date, end date")
    cache = plan.filter("start < '2025-02-15'").unionAll(plan.filter("start < '2025-01-15'"))
    got = rows(chunks.split_by_cache(plan, cache, ["k"], "2025-02-10"), "start")
    assert [r["source"] for r in got] == ["cached", "fetch", "fetch"]
    assert chunks.cached_rows(plan, cache, ["k"], "2025-02-10").count() == 2
    whole = chunks.cacheable(plan.union(spark.createDataFrame([month("2025-01-02", "2025-01-31")], plan.schema)), "start", "end")
    assert whole.count() == 3


def test_retries_and_cache_keys(spark, rows):
    df = spark.createDataFrame([("r1", 1, 500), ("r1", 2, 200), ("r2", 1, 500), ("r2", 2, 500)], "id string, attempt int, status_code int")
    assert [(r["id"], r["given_up"]) for r in rows(usage.merge_attempts(df, ["id"], 2), "id")] == [("r1", False), ("r2", True)]
    keyed = cache_rows(spark.createDataFrame([("a", "s", "c", "2025-01-01")], "advertiser_id string, store_id string, campaign_id string, start_date string"), "u@x", "2025-01-02")
    assert keyed.first()["_id"] == "u@x_a_s_c___2025-01-01_None_None"


def test_templates_and_registry(spark, tmp_path):
    groups = spark.createDataFrame([("T", 1, ["a", "b"]), ("T", 2, ["b", "c"]), ("U", 1, ["z"])], "template string, group_no int, fields array<string>")
    assert [r["field"] for r in templates.selectable_fields(groups, "T").orderBy("position").collect()] == ["a", "b", "c"]
    assert templates.template("LOCATION_DETAILED_REPORT").breakdowns == ("country", "region") and len(templates.TEMPLATES) == 17
    assert templates.insight_fields("ad", ["spend"], ["spend", "other"])[-2:] == ["purchase_roas", "ad_id"]
    df = spark.createDataFrame([("ACTIVE", "0"), ("DELETED", "5")], "effective_status string, spend string")
    assert templates.reportable(df, "campaign").count() == 2 and templates.reportable(df, "ad").count() == 1 and templates.spending(df).count() == 1
    reg = default_registry()
    reg.register("mine", lambda: None)
    assert reg.types()[-1] == "mine"
    with pytest.raises(ValueError, match="known types: creative"):
        reg.get("nope")
    with pytest.raises(TypeError):
        ReportRegistry().register("x", "not callable")
    seed = tmp_path / "seed.csv"
    seed.write_text("region_code,region_name,region_type,macro_region\nVN-43,Bà Rịa–Vũng Tàu Province,tỉnh,South\n", encoding="utf-8")
    assert files.read_seed(spark, str(seed)).first()["region_name"] == "Bà Rịa–Vũng Tàu Province"
