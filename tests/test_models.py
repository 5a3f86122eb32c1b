import datetime as dt
import json

import pytest
from conftest import ts
from pyspark.sql import functions as F

from adlake.operators.quality import Check, at_least_one, not_null, relationship, run_suite, unique
from adlake.plans import gold, silver, specs
from adlake.plans.build import Warehouse, build, daily_schema
from adlake.schemas import RAW, REGION_SEED
from adlake.sources import landing
from adlake.sources.seeds import region_seed
from adlake.sources.tables import KeyedTable


def raw(spark, *items):
    """(job, created_at, payload) triples; a payload may be broken text."""
    return spark.createDataFrame(
        [(j, ts(t), p if isinstance(p, str) else json.dumps(p, ensure_ascii=False)) for j, t, p in items], RAW
    )


def act(kind, value):
    return {"action_type": kind, "value": value}


def test_metric_counts():
    assert [len(s.metrics) for s in specs.DAILY] == [57, 6, 26, 6, 23, 20]
    assert len(specs.ACTION_METRICS.strip().splitlines()) == 62


def test_edge_rows(spark, rows):
    df = silver.daily(
        raw(
            spark,
            ("j1", "2025-01-02", {"campaign_id": "c1", "date_start": "2025-01-01", "date_stop": "2025-01-01", "spend": "12.5",
                                  "clicks": 3, "cpc": "n/a", "campaign_name": "Chiến dịch – 1",
                                  "actions": [act("comment", "4"), act("comment", "9"), act("video_view", 2)]}),
            ("j1", "2025-01-02", {"campaign_id": "c2", "date_start": "", "actions": []}),
            ("j1", "2025-01-02", "{broken"),
        ),
        specs.CAMPAIGN,
    )
    got = {r["surrogate_key"]: r for r in rows(df)}
    assert set(got) == {"c1_2025-01-01", "c2_", "_"}
    one = got["c1_2025-01-01"]
    assert (one["spend"], one["clicks"], one["cpc"], one["reach"]) == (12.5, 3.0, 0.0, 0.0)
    assert (one["comment_count"], one["video_view_count"], one["post_reaction_count"]) == (4.0, 2.0, 0.0)
    assert one["campaign_name"] == "Chiến dịch – 1" and one["account_id"] == ""
    assert got["c2_"]["date_start"] is None and got["c2_"]["date_stop"] is None


def test_newest_version_wins_and_ties_are_settled(spark, rows):
    base = {"campaign_id": "c", "date_start": "2025-01-01"}
    df = silver.daily(
        raw(
            spark,
            ("j1", "2025-01-02", base | {"spend": "1"}), ("j2", "2025-01-03", base | {"spend": "2"}),
            ("j1", "2025-01-03", base | {"spend": "3"}), ("j2", "2025-01-03", base | {"spend": "4"}),
        ),
        specs.CAMPAIGN,
    )
    assert [r["spend"] for r in rows(df)] == [4.0]


def test_ad_id_falls_back_to_id(spark, rows):
    df = silver.daily(
        raw(spark, ("j", "2025-01-02", {"id": "a1", "date_start": "2025-01-01"}), ("j", "2025-01-02", {"ad_id": "a2", "id": "x", "date_start": "2025-01-01"})),
        specs.AD,
    )
    assert [r["ad_id"] for r in rows(df, "ad_id")] == ["a1", "a2"]


def test_plan_parses_once_per_step(spark):
    plan = silver.daily(raw(spark, ("j", "2025-01-02", {})).filter("job_id > ''"), specs.ACCOUNT)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(") == 2  # the key, then the winner's whole payload
    assert "WindowGroupLimit" in plan and "Python" not in plan
    assert plan.count("Exchange") == 1


def test_entities(spark, rows):
    item = {"id": "1", "name": "n", "creative_thumbnail_raw_url": "u", "creative_link": "l"}
    landed = raw(
        spark,
        ("j", "2025-01-01", item | {"_template": "Ad Creative Daily Report"}),
        ("j", "2025-01-02", item | {"name": "m", "_template": "LOCATION_DETAILED_REPORT"}),
        ("j", "2025-01-03", item | {"name": "set", "_template": "Ad Set Daily Report"}),
    )
    ad = rows(silver.ad_metadata(landed))
    assert [(r["name"], r["creative_thumbnail_url"], r["creative_link_url"]) for r in ad] == [("m", "u", "l")]
    assert [r["name"] for r in rows(silver.ad_set_metadata(landed))] == ["set"]


def test_regions(spark, rows):
    seed = spark.createDataFrame([("VN-04", "Cao Bằng Province", "tỉnh", "North")], REGION_SEED)
    places = spark.createDataFrame([(" Cao Bằng Province ", "VN"), ("Atlantis", ""), ("Atlantis", "")], "region string, country string")
    df = gold.dim_regions(places, seed, F.lit("2025-01-01").cast("timestamp"))
    assert [(r["region"], r["region_code"], r["macro_region"]) for r in rows(df, "region")] == [
        (" Cao Bằng Province ", "VN-04", "North"), ("Atlantis", None, "Unknown"),
    ]
    df.collect()
    assert "BroadcastHashJoin" in df._jdf.queryExecution().executedPlan().toString()


def test_shipped_seed(spark, rows):
    seed = region_seed(spark)
    assert seed.count() == 63 and seed.select("region_code").distinct().count() == 63
    places = spark.createDataFrame([("Bà Rịa–Vũng Tàu Province", "VN"), ("Hanoi ", "VN")], "region string, country string")
    got = rows(gold.dim_regions(places, seed), "region")
    assert [(r["region_code"], r["macro_region"]) for r in got] == [("VN-43", "South"), ("VN-HN", "North")]


def test_quality(spark, rows):
    df = spark.createDataFrame([(1, "a"), (1, None), (None, None)], "id int, v string")
    assert not_null(df, "v").count() == 2 and unique(df, "id").count() == 1
    assert at_least_one(df, "v").count() == 0 and at_least_one(df.filter("v = 'z'"), "v").count() == 1
    assert relationship(df, "id", df.filter("id > 1"), "id").count() == 2
    checks = [
        Check("t", "not_null", "v"), Check("t", "unique", "id"), Check("t", "unique", "v"), Check("t", "at_least_one", "v"),
        Check("e", "at_least_one", "v"), Check("t", "relationships", "id", "e", "id"),
    ]
    got = {(r["model"], r["test"], r["column"]): r["failures"] for r in rows(run_suite({"t": df, "e": df.limit(0)}, checks))}
    assert got == {
        ("t", "not_null", "v"): 2, ("t", "unique", "id"): 1, ("t", "unique", "v"): 0, ("t", "at_least_one", "v"): 0,
        ("e", "at_least_one", "v"): 1, ("t", "relationships", "id"): 2,
    }
    with pytest.raises(ValueError, match="unknown test"):
        run_suite({"t": df}, [Check("t", "nope", "v")])


# -- keyed tables ------------------------------------------------------------------------


@pytest.mark.parametrize("partition", [None, "date_start"])
def test_upsert_is_idempotent_and_chunkwise_equals_full(spark, rows, tmp_path, partition):
    def load(n):
        return raw(spark, *[
            (f"j{n}", f"2025-02-0{n}", {"campaign_id": f"c{i}", "date_start": f"2025-01-0{1 + i % 3}", "spend": str(10 * n + i)})
            for i in range(n, n + 4)
        ])

    keys = ("surrogate_key", "date_start")
    table = KeyedTable(str(tmp_path / "t"), daily_schema(specs.CAMPAIGN), keys, ties=("job_id",), partition=partition)
    assert table.watermark(spark) is None
    for n in (1, 2, 3):
        table.upsert(silver.daily(load(n), specs.CAMPAIGN))
    want = rows(silver.daily(load(1).union(load(2)).union(load(3)), specs.CAMPAIGN), "surrogate_key")
    assert rows(table.read(spark), "surrogate_key") == want
    table.upsert(silver.daily(load(2), specs.CAMPAIGN))
    assert rows(table.read(spark), "surrogate_key") == want
    assert table.watermark(spark) == dt.datetime(2025, 2, 3)


def test_upsert_rewrites_only_touched_partitions(spark, tmp_path):
    table = KeyedTable(str(tmp_path / "t"), daily_schema(specs.CAMPAIGN), ("surrogate_key", "date_start"), partition="date_start")
    item = lambda d, s: silver.daily(raw(spark, ("j", "2025-02-01", {"campaign_id": "c", "date_start": d, "spend": s})), specs.CAMPAIGN)
    table.upsert(item("2025-01-01", "1").union(item("2025-01-02", "2")))
    untouched = {p: p.stat().st_mtime_ns for p in (tmp_path / "t" / "date_start=2025-01-01").iterdir()}
    table.upsert(item("2025-01-02", "5"))
    assert {p: p.stat().st_mtime_ns for p in (tmp_path / "t" / "date_start=2025-01-01").iterdir()} == untouched
    assert table.read(spark).count() == 2


def test_delete_insert_and_delete(spark, rows, tmp_path):
    frame = lambda *r: spark.createDataFrame(list(r), "id string, created_at timestamp")
    early = dt.datetime(2025, 1, 1)
    table = KeyedTable(str(tmp_path / "t"), frame(("x", early)).schema, ("id",))
    table.upsert(frame(("a", dt.datetime(2025, 1, 5)), ("b", early)))
    table.delete_insert(frame(("a", early)))  # older, but delete+insert does not compare versions
    assert [r["created_at"] for r in rows(table.read(spark), "id")] == [early, early]
    assert table.delete(frame(("a", early)), "id") == 1
    assert [r["id"] for r in rows(table.read(spark))] == ["b"]
    assert table.delete(frame(("zz", early)), "id") == 0
    assert table.delete(None, "id") == 1 and table.read(spark).count() == 0


def test_half_written_snapshot_is_ignored(spark, tmp_path):
    frame = spark.createDataFrame([("a", dt.datetime(2025, 1, 1))], "id string, created_at timestamp")
    table = KeyedTable(str(tmp_path / "t"), frame.schema, ("id",))
    table.upsert(frame)
    (tmp_path / "t" / "snapshot=2").mkdir()
    assert table.read(spark).count() == 1
    table.upsert(frame)
    assert table.read(spark).count() == 1


def test_landing(spark, rows, tmp_path):
    root = str(tmp_path)
    metrics = spark.createDataFrame([("1", "Tên"), ("2", None)], "id string, name string")
    stats = landing.land_report(root, "Ad Daily Report", "j", metrics, metrics.limit(1))
    assert stats == {"metrics_rows": 2, "metadata_rows": 1, "total_rows": 3}
    got = rows(landing.read_raw(spark, root, "raw_fb_ad_daily_report_metrics"))
    assert {r["data"] for r in got} == {'{"id":"1","name":"Tên","_template":"Ad Daily Report"}', '{"id":"2","_template":"Ad Daily Report"}'}
    assert len({r["created_at"] for r in got}) == 1
    assert landing.append_raw(root, "empty", landing.to_raw(metrics.limit(0), "j")) == 0
    assert landing.read_raw(spark, root, "empty").count() == 0
    assert landing.read_raw(spark, root, "raw_fb_ad_daily_report_metrics", since=got[0]["created_at"]).count() == 0


def test_build(spark, rows, tmp_path):
    root, house = str(tmp_path / "landing"), Warehouse(str(tmp_path / "house"))
    seed = spark.createDataFrame([("VN-HN", "Hanoi", "thành phố", "North")], REGION_SEED)

    def land(day, spend):
        for spec in specs.DAILY:
            item = {"account_id": "act_1", "account_name": "A", "campaign_id": "c1", "adset_id": "s1", "ad_id": "a1", "region": "Hanoi",
                    "date_start": "2025-01-01", "date_stop": "2025-01-01", "spend": spend, "age": "18-24", "gender": "male"}
            landing.append_raw(root, spec.source, raw(spark, ("j" + day, day, item)))
        entity = {"id": "a1", "name": "Ad " + day, "campaign_id": "c1", "_template": "LOCATION_DETAILED_REPORT"}
        landing.append_raw(root, landing.SHARED_METADATA, raw(spark, ("j" + day, day, entity)))

    for day, spend in (("2025-01-02", "1"), ("2025-01-03", "2")):
        land(day, spend)
        checks = rows(build(spark, root, house, seed))
        assert {c["failures"] for c in checks} == {0}, checks
    build(spark, root, house, seed)  # nothing new
    assert [r["spend"] for r in rows(house.gold["fact_campaigns_daily"].read(spark))] == [2.0]
    assert [r["ad_name"] for r in rows(house.gold["dim_ads"].read(spark))] == ["Ad 2025-01-03"]
    assert [r["macro_region"] for r in rows(house.gold["dim_regions"].read(spark))] == ["North"]
