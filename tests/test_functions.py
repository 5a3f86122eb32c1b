import datetime as dt

import pytest
from pyspark.sql import functions as F

from adlake.functions import api_errors as ae
from adlake.functions import dates, text
from adlake.functions.jsonx import all_zero, day, first_action, number, surrogate_key
from adlake.operators.pivot import Metric
from adlake.schemas import ACTIONS


def one(spark, col):
    return spark.range(1).select(col.alias("x")).first()["x"]


def day_of(s):
    return F.lit(s).cast("date")


def ranges(spark, col):
    return [(str(r["start"]), str(r["end"])) for r in one(spark, col)]


def test_number_defaults(spark):
    df = spark.createDataFrame([("1.5",), (None,), ("n/a",), ("",), ("7",)], "v string")
    assert [r[0] for r in df.select(number(F.col("v"))).collect()] == [1.5, 0.0, 0.0, 0.0, 7.0]


def test_day_is_lenient_unless_told(spark):
    df = spark.createDataFrame([("2025-01-02",), ("",), (None,), ("later",)], "v string")
    assert [r[0] for r in df.select(day(F.col("v"))).collect()] == [dt.date(2025, 1, 2), None, None, None]
    with pytest.raises(Exception, match="CAST|parse|PARSE"):
        df.select(day(F.col("v"), strict=True)).collect()


@pytest.mark.parametrize("wide", [True, False])
def test_first_action_takes_the_first_hit(spark, wide):
    cases = [
        ('[{"action_type":"like","value":"4"},{"action_type":"like","value":"9"}]', 4.0),
        ('[{"action_type":"other","value":"1"},{"action_type":"like","value":3}]', 3.0),
        ('[{"action_type":"like"}]', 0.0),
        ('[{"action_type":null,"value":"5"},{"action_type":"like","value":"6"}]', 6.0),
        ("[]", 0.0),
        (None, 0.0),
        ('[{"action_type":"like","value":"x"}]', 0.0),
    ]
    df = spark.createDataFrame(cases, "j string, want double").select(
        F.struct(F.from_json("j", ACTIONS).alias("actions")).alias("p"), "want"
    )
    col = Metric.of("got", "actions:like").column("p") if wide else first_action(F.col("p.actions"), "like").alias("got")
    assert all(r["got"] == r["want"] for r in df.select(col, "want").collect())


def test_surrogate_key_keeps_empty_parts(spark):
    df = spark.createDataFrame([("a", None, "c")], "x string, y string, z string")
    assert df.select(surrogate_key(F.col("x"), F.col("y"), F.col("z"))).first()[0] == "a__c"


def test_all_zero(spark):
    df = spark.createDataFrame([("0", None), ("0.0", "0"), ("1", "0"), (None, "2")], "a string, b string")
    assert [r[0] for r in df.select(all_zero(F.col("a"), F.col("b"))).collect()] == [True, True, False, False]


# -- dates -------------------------------------------------------------------------------


def test_month_ranges(spark):
    assert ranges(spark, dates.month_ranges(day_of("2025-01-15"), day_of("2025-03-05"))) == [
        ("2025-01-15", "2025-01-31"), ("2025-02-01", "2025-02-28"), ("2025-03-01", "2025-03-05"),
    ]
    assert ranges(spark, dates.month_ranges(day_of("2025-03-05"), day_of("2025-01-15"))) == []


def test_split_and_reduce(spark):
    s, e = day_of("2025-01-01"), day_of("2025-01-31")
    assert ranges(spark, dates.split_months(s, e, 2)) == [("2025-01-01", "2025-01-16"), ("2025-01-17", "2025-01-31")]
    assert ranges(spark, dates.reduced_ranges(s, e)) == [
        ("2025-01-01", "2025-01-15"), ("2025-01-16", "2025-01-30"), ("2025-01-31", "2025-01-31"),
    ]
    assert ranges(spark, dates.reduced_ranges(s, s)) == [("2025-01-01", "2025-01-01")]


def test_week_ranges(spark):
    assert ranges(spark, dates.week_ranges(day_of("2025-01-01"), day_of("2025-01-10"))) == [
        ("2025-01-01", "2025-01-07"), ("2025-01-08", "2025-01-10"),
    ]


@pytest.mark.parametrize(
    ("s", "e", "strict", "loose"),
    [
        ("2025-09-01", "2025-09-30", True, True), ("2025-09-15", "2025-09-30", False, False),
        ("2025-01-01", "2025-02-28", False, True), ("2024-02-01", "2024-02-28", False, False),
    ],
)
def test_full_month(spark, s, e, strict, loose):
    assert one(spark, dates.is_full_month(day_of(s), day_of(e))) is strict
    assert one(spark, dates.is_full_month(day_of(s), day_of(e), strict=False)) is loose


def test_trailing_window(spark):
    w = one(spark, dates.trailing_window(day_of("2025-03-31")))
    assert (str(w["start"]), str(w["end"])) == ("2025-03-01", "2025-03-31")


# -- text --------------------------------------------------------------------------------


def test_table_names(spark):
    assert text.raw_table("AGE & GENDER_DETAILED_REPORT", "_metrics") == "raw_fb_age___gender_detailed_report_metrics"
    assert text.raw_table("Campaign Daily Report") == "raw_fb_campaign_daily_report"


@pytest.mark.parametrize(
    ("url", "want"),
    [
        ("https://graph.example.com/v24.0/act_1/insights?access_token=S&level=ad&q=a%20b", "act_1/insights?level=ad&q=a+b"),
        ("https://h/v23.0/x?access_token=S", "x"),
        ("https://h/x?a=1&b=&a=2&c=%7E*", "x?a=1&a=2&c=~%2A"),
        ("", ""),
    ],
)
def test_relative_url(spark, url, want):
    assert one(spark, text.relative_url(F.lit(url))) == want


def test_next_page(spark):
    def nxt(n, a, o):
        return one(spark, text.next_page_url(F.lit(n).cast("string"), F.lit(a).cast("string"), F.lit(o)))

    assert nxt("https://n", "c", "https://h/x?a=1") == "https://n"
    assert nxt(None, "c", "https://h/x?a=1&before=b&k=") == "https://h/x?a=1&k=&after=c"
    assert nxt(None, "c2", "https://h/x?after=c1&a=1") == "https://h/x?after=c2&a=1"
    assert nxt(None, None, "https://h/x?a=1") is None


@pytest.mark.parametrize(
    "url",
    [
        'x?time_range={"since":"2025-01-02","until":"2025-03-04"}&a=1',
        "x?time_range=%7B%22since%22%3A+%222025-01-02%22%2C+%22until%22%3A+%222025-03-04%22%7D",
        "insights.time_range({'since':'2025-01-02','until':'2025-03-04'}).limit(5)",
    ],
)
def test_time_range(spark, url):
    assert one(spark, text.url_since(F.lit(url))) == dt.date(2025, 1, 2)
    assert one(spark, text.url_until(F.lit(url))) == dt.date(2025, 3, 4)


def test_small_text_helpers(spark):
    assert one(spark, text.image_formula(F.lit("u"))) == '=IMAGE("u")'
    assert one(spark, text.image_formula(F.lit(""))) == ""
    assert one(spark, text.prefixed(text.STORY_LINK, F.lit(None).cast("string"))) == ""
    assert one(spark, text.short_id(F.lit("0123456789"))) == "01234567"
    assert one(spark, text.mail_name(F.lit("me@x.io"))) == "me"
    assert one(spark, text.endpoint_name(F.lit("https://h/open_api/v1.3/gmv/report/"))) == "gmv/report"


# -- API errors ----------------------------------------------------------------------------


@pytest.mark.parametrize(
    ("code", "sub", "kind", "wait"),
    [
        (4, None, "rate_limit", 300), (17, 2446079, "rate_limit", 300), (17, None, "rate_limit", 180),
        (80000, None, "rate_limit", 600), (80004, None, "rate_limit", 600), (613, None, "rate_limit", 180),
        (99, 1996, "rate_limit", 180), (200, None, "permission", 0), (190, 2446079, "rate_limit", 180),
        (503, None, "server_error", 30), (404, None, "invalid_request", 0), (1, None, "unknown", 60), (None, None, "unknown", 60),
    ],
)
def test_error_classes(spark, code, sub, kind, wait):
    c, s = F.lit(code).cast("int"), F.lit(sub).cast("int")
    k = ae.error_type(c, s)
    assert one(spark, k) == kind
    assert one(spark, ae.error_backoff(k, c, s)) == wait


def limits(app=0.0, insights=0.0, eta=0, calls=0, cpu=0, wall=0):
    use = F.struct(F.lit(calls).alias("call_count"), F.lit(cpu).alias("total_cputime"), F.lit(wall).alias("total_time"))
    account = F.struct(
        F.lit("act").alias("account_id"), F.lit(float(insights)).alias("insights_usage_pct"), F.lit(eta).alias("eta_seconds"),
        F.array(use).alias("business_use_cases"),
    )
    return F.struct(F.lit(float(app)).alias("app_usage_pct"), F.array(account).alias("account_details"))


@pytest.mark.parametrize(
    ("error", "summary", "cap", "action", "seconds"),
    [
        (0, {"app": 10}, 360, "none", 0),
        (300, {}, 360, "wait", 305),
        (0, {"app": 96}, 360, "wait", 305),
        (600, {}, 360, "abort", 0),
        (600, {}, 660, "wait", 605),
        (180, {"app": 99}, 360, "wait", 305),
        (0, {"eta": 150}, 360, "wait", 155),
        (0, {"cpu": 95}, 360, "wait", 305),
        (0, {"wall": 75}, 360, "wait", 125),
        (0, {"calls": 150, "wall": 50}, 360, "wait", 65),
        (0, {"insights": 80}, 360, "wait", 65),
    ],
)
def test_decisions(spark, error, summary, cap, action, seconds):
    wait = F.greatest(F.lit(error), ae.summary_backoff(limits(**summary)))
    d = one(spark, ae.decision(wait, cap))
    assert (d["action"], d["seconds"]) == (action, seconds)


def test_summary_only_ignores_times(spark):
    d = one(spark, ae.decision(ae.summary_backoff(limits(eta=700, cpu=99), with_times=False), ae.SUMMARY_CAP, ae.SUMMARY_EXTRA))
    assert (d["action"], d["seconds"]) == ("wait", 703)
