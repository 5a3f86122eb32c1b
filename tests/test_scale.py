"""What keeps large loads within their memory: folders per month, bounded landing partitions, narrow shuffles."""

import datetime as dt
import json

from conftest import ts
from pyspark.sql import functions as F

from adlake.llm import near_dup
from adlake.operators import latest
from adlake.plans import shop, silver, specs
from adlake.plans.build import Warehouse
from adlake.schemas import RAW
from adlake.sources import landing as lands
from adlake.workload import derive


def test_daily_tables_have_a_folder_per_month(spark, tmp_path):
    table = Warehouse(str(tmp_path)).silver["stg_campaign_daily"]
    days = [None, *[str(dt.date(2025, 1, 1) + dt.timedelta(d)) for d in range(90)]]

    def load(job, spend, chosen):
        rows = [(job, ts("2025-04-01"), json.dumps({"campaign_id": "c", "date_start": d, "spend": spend})) for d in chosen]
        return silver.daily(spark.createDataFrame(rows, RAW), specs.CAMPAIGN)

    table.upsert(load("j1", "1", days))
    folders = [p for p in (tmp_path / "silver" / "stg_campaign_daily").iterdir() if p.is_dir()]
    assert len(folders) == 4
    before = {p: p.stat().st_mtime_ns for f in folders for p in f.iterdir() if "2025-01" in f.name}
    table.upsert(load("j2", "2", [None, "2025-03-31"]))
    assert before and {p: p.stat().st_mtime_ns for p in before} == before
    got = {str(r["date_start"]): r["spend"] for r in table.read(spark).collect()}
    assert got == {str(d): 2.0 if d in (None, "2025-03-31") else 1.0 for d in days}
    assert table.read(spark).columns == table.schema.fieldNames()


def test_landing_partitions_are_bounded_by_the_bytes_they_come_from(spark, tmp_path, monkeypatch):
    rows = [(n, n % 50, n % 9, n % 7 + 1, 5.0, 100.0, 0.1, 0.2, "A", "O", dt.datetime(1995, 1, 1 + n % 28)) for n in range(5000)]
    names = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp"
    spark.createDataFrame(rows, names).coalesce(1).write.parquet(f"{tmp_path}/lineitem.parquet")
    size = sum(p.stat().st_size for p in (tmp_path / "lineitem.parquet").glob("*.parquet"))
    monkeypatch.setattr(derive, "LANDING_PART_BYTES", size // 20)
    raw = derive.insight_landing(spark, str(tmp_path), specs.ACCOUNT)
    assert raw.rdd.getNumPartitions() >= 20
    assert raw.count() == 5000


def landing(spark, *rows):
    return spark.createDataFrame([(j, ts(c), d if isinstance(d, str) else json.dumps(d)) for j, c, d in rows], RAW)


def exchanged(df):
    """What the exchange below the newest step carries."""
    plan = df._jdf.queryExecution().executedPlan().toString().splitlines()
    at = next(i for i, line in enumerate(plan) if "Exchange hashpartitioning(k_" in line)
    return next(line for line in plan[at:] if " Project [" in line)


def test_daily_models_shuffle_typed_columns_not_documents(spark):
    raw = landing(spark, ("j", "2025-01-02", {"campaign_id": "c", "date_start": "2025-01-01"}))
    carried = exchanged(silver.daily(silver.settled(raw), specs.CAMPAIGN))
    assert "document#" in carried and " data#" not in carried and "AS comment_count#" in carried
    regions = exchanged(silver.daily(silver.settled(raw), specs.LOCATION).select("region", "country"))
    assert "AS country#" in regions and "comment_count#" not in regions


def test_documents_settle_the_versions_that_share_a_job_and_no_others(spark, rows):
    doc = lambda key, spend: {"campaign_id": key, "date_start": "2025-01-01", "spend": spend}
    raw = landing(
        spark, ("j1", "2025-01-02", doc("c", "3")), ("j1", "2025-01-02", doc("c", "7")), ("j1", "2025-01-02", doc("d", "5")),
        ("j2", "2025-01-02", doc("e", "1")), ("j3", "2025-01-03", doc("e", "2")), (None, "2025-01-02", doc("f", "8")), (None, "2025-01-02", doc("f", "9")),
    )
    kept = {r["data"]: r["document"] for r in rows(silver.settled(raw))}
    assert sorted(d is not None for d in kept.values()) == [False] * 2 + [True] * 5
    want = {"c": 7.0, "d": 5.0, "e": 2.0, "f": 9.0}
    for listed in (0, 1, 100):
        some = latest.with_deciding_text(raw, ["created_at", "job_id"], "data", "document", listed)
        assert {r["campaign_id"]: r["spend"] for r in rows(silver.daily(some, specs.CAMPAIGN))} == want
    assert {r["campaign_id"]: r["spend"] for r in rows(silver.daily(raw, specs.CAMPAIGN))} == want


def test_broken_documents_are_grouped_by_their_key_fields_read_alone(spark, rows):
    cut = '{"account_id":"a","date_start":"2025-01-01","actions":[{"action_type":"comment","value":"1"},{"action_type"::}]}'
    raw = landing(spark, ("j1", "2025-01-02", {"account_id": "a", "date_start": "2025-01-01", "spend": "1"}), ("j2", "2025-01-03", cut))
    got = [(r["surrogate_key"], r["account_id"], r["job_id"], r["spend"]) for r in rows(silver.daily(raw, specs.ACCOUNT), "job_id")]
    # the broken one is no version of the other
    assert got == [("a_2025-01-01", "a", "j1", 1.0), ("a_2025-01-01", "a", "j2", 0.0)]


def test_strict_dates_are_asked_of_the_newest_row_only(spark, rows):
    raw = landing(
        spark, ("j1", "2025-01-02", {"campaign_id": "c", "date_start": "2025-01-01", "date_stop": "soon"}),
        ("j2", "2025-01-03", {"campaign_id": "c", "date_start": "2025-01-01", "date_stop": "2025-01-01"}),
    )
    got = rows(silver.daily(raw, specs.CAMPAIGN, strict_dates=True))
    assert [str(r["date_stop"]) for r in got] == ["2025-01-01"]


def test_documents_are_made_after_landing_rows_were_moved_and_sorted(spark, rows, tmp_path):
    lines = spark.createDataFrame([(f"j{n}", ts(f"2025-0{n % 3 + 1}-02"), n) for n in range(9)], "job_id string, created_at timestamp, n int")
    document = F.to_json(F.struct("n"))
    plan = lands.arranged(lines, "MM", many_days=True, document=document)._jdf.queryExecution().executedPlan().toString()
    made, moved = plan.index("StructsToJson"), min(plan.index("Sort ["), plan.index("Exchange "))
    assert made < moved and "StructsToJson" not in plan[moved:]
    assert lands.append_raw(str(tmp_path), "t", lines, grain="MM", many_days=True, document=document) == 9
    want = [(f"j{n}", ts(f"2025-0{n % 3 + 1}-02"), f'{{"n":{n}}}') for n in range(9)]
    assert [tuple(r.values()) for r in rows(lands.read_raw(spark, str(tmp_path), "t"), "job_id")] == want


def test_campaign_columns_are_joined_last(spark):
    campaigns = spark.createDataFrame([("c", "N", "ENABLE", "adv")], "campaign_id string, campaign_name string, operation_status string, advertiser_id string")
    lines = spark.createDataFrame([("c", "g", "i", "1", "1")], "campaign_id string, item_group_id string, item_id string, cost string, orders string")
    catalog = spark.createDataFrame([("g", "T", "S", "u", 1)], "item_group_id string, title string, status string, product_image_url string, seq int")
    meta = spark.createDataFrame([("c", "g", "i", "V", "a", "b", "")], "campaign_id string, item_group_id string, item_id string, title string, tt_account_name string, tt_account_profile_image_url string, product_img string")
    out = shop.creative_report(campaigns, lines.select("campaign_id", "item_group_id"), lines, catalog, meta, ["cost", "orders"])
    outermost = next(line for line in out._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join" in line)
    assert outermost.count("campaign_id") == 2 and "item_group_id" not in outermost
    assert out.count() == 1


def test_near_duplicates_move_texts_by_a_shuffle(spark, monkeypatch):
    seen, staged = {}, near_dup.staged

    def note(df, name):
        seen.setdefault(name, df._jdf.queryExecution().executedPlan().toString())
        return staged(df, name)

    monkeypatch.setattr(near_dup, "staged", note)
    text = "one two three four five six seven eight"
    docs = spark.createDataFrame([(1, text), (2, text + " nine"), (2, ""), (3, "other words are here for you")], "doc_id long, text string")
    got = {r["doc_id"]: r["class_id"] for r in near_dup.near_duplicates(docs, 0.7).collect()}
    assert got == {1: 1, 2: 1, 3: 3}
    assert "SortMergeJoin" in seen["texts"] and "BroadcastHashJoin" not in seen["texts"]


def test_a_model_asked_for_some_columns_gives_those_of_the_whole_model(spark, rows):
    spec, keys = specs.AD, ("surrogate_key", "job_id", "created_at", "ad_id", "campaign_name", "date_stop")
    day = {"date_start": "2025-01-01", "date_stop": "2025-01-02"}
    documents = [
        {"ad_id": "a", "campaign_name": "N", **day}, {"id": "b", "campaign_name": 5, **day}, {"ad_id": "", "id": "c", "campaign_name": None, **day},
        {"ad_id": {"x": [1, "y"]}, "campaign_name": [1, 2.50], **day}, {"ad_id": "d", **day, "actions": "none"}, {"ad_id": "e", **day, "actions": [1, {"action_type": 2}]},
        {"ad_id": "f", **day, "actions": {"action_type": "comment", "value": "1"}}, {"ad_id": "g", "date_start": "no day", "date_stop": "none"},
        '{"ad_id":"h","date_start":"2025-01-01","actions":[{"action_type":"comment","value":"1"},{"action_type"::}],"campaign_name":"late"}',
        '{"ad_id":"i","date_start":"2025-01-01"', '{"ad_id":"j","ad_id":"k","date_start":"2025-01-01"}', '{"ad_id":"l","date_start":"2025-01-01","spend":01}',
        '[{"ad_id":"m","date_start":"2025-01-01"},{"ad_id":"n"}]', "[]", "{}", "", "no json", "5", '"text"', '{"ad_id":"o\\\\q","date_start":"2025-01-01"}', None,
    ]
    texts = [d if d is None or isinstance(d, str) else json.dumps(d) for d in documents]
    raw = spark.createDataFrame([(f"j{i % 3}", ts(f"2025-01-{i % 5 + 1:02}"), d) for i, d in enumerate(texts * 2)], RAW)
    for some in (keys, ("surrogate_key",), ("job_id", "created_at", "account_name"), ("ad_id", "spend")):
        got = silver.settled_daily(raw, spec, some)
        assert got.columns == [c for c in silver.daily(raw, spec).columns if c in some]
        assert rows(got, *got.columns) == rows(silver.daily(raw, spec).select(*got.columns), *got.columns)
    one = [rows(silver.daily(raw.filter(F.col("data") == d), spec, columns=keys)) for d in texts if d is not None]
    assert one == [rows(silver.daily(raw.filter(F.col("data") == d), spec).select(*keys)) for d in texts if d is not None]
    plan = silver.daily(raw, spec, columns=keys)._jdf.queryExecution().optimizedPlan().toString()
    first = next(line for line in reversed(plan.splitlines()) if "from_json" in line)
    assert "campaign_name" in first and "actions" not in first
