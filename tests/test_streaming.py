import datetime as dt

import pytest
from conftest import ts
from test_operators import START, call_log

from adlake.operators.joblog import lifecycle
from adlake.session import shared_dir
from adlake.streaming import counters, ingest, quota
from adlake.streaming.lifecycle import read_jobs, run_lifecycle


def stream_of(spark, tmp_path, frames, schema):
    """A file stream that sees one frame per micro-batch."""
    for i, rows in enumerate(frames):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in" / f"part={i}"))
    return spark.readStream.schema(schema + ", part int").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in")).drop("part")


@pytest.mark.parametrize("batches", [1, 3])
def test_first_hit_quota(spark, tmp_path, batches):
    calls = sorted(call_log(300, ["hot", "b", "c"], 120, 5), key=lambda c: c[2])
    size = len(calls) // batches + 1
    frames = [calls[i : i + size] for i in range(0, len(calls), size)]
    stream = stream_of(spark, tmp_path, frames, "id int, k string, t timestamp")
    rules = [(20, 30), (2, 1)]
    out = quota.first_hit_quota(stream, "k", "id", "t", rules, late="1 hour")
    q = out.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp"))
    q.outputMode("append").trigger(availableNow=True).start().awaitTermination()
    got = {int(r["call_id"]): r["allowed"] for r in spark.read.parquet(str(tmp_path / "out")).collect()}

    counters_, want = {}, {}
    for i, k, t in calls:
        ok = True
        for limit, period in ((2, 1), (20, 30)):
            opened, used = counters_.get((k, period), (None, 0))
            if opened is None or t >= opened + dt.timedelta(seconds=period):
                opened, used = t, 0
            counters_[k, period] = (opened, used + 1)
            if used + 1 > limit:
                ok = False
                break
        want[i] = ok
    assert got == want and 0 < sum(want.values()) < len(want)


def test_hourly_counts_over_batches(spark, tmp_path, rows):
    t = lambda h, m: START + dt.timedelta(hours=h, minutes=m)
    frames = [[("e", t(0, 5)), ("f", t(0, 6))], [("e", t(0, 59)), ("e", t(1, 0))]]
    stream = stream_of(spark, tmp_path, frames, "endpoint string, ts timestamp")
    counts = counters.hourly_counts(stream, "endpoint", "ts")
    ingest.update_stream(counts, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    got = rows(ingest.read_updates(spark, str(tmp_path / "out"), ["endpoint", "hour"]), "endpoint", "hour")
    assert [(r["endpoint"], r["hour"].hour, r["calls"]) for r in got] == [("e", 0, 2), ("e", 1, 1), ("f", 0, 1)]


def test_sliding_counts(spark, tmp_path, rows):
    frames = [[("a", START + dt.timedelta(seconds=s)) for s in (0, 5, 30)]]
    counts = counters.sliding_counts(stream_of(spark, tmp_path, frames, "k string, ts timestamp"), "k", "ts", seconds=20, step=5)
    ingest.update_stream(counts, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    got = {int((r["window_start"] - START).total_seconds()): r["calls"] for r in rows(ingest.read_updates(spark, str(tmp_path / "out"), ["key", "window_start"]))}
    assert got == {-15: 1, -10: 2, -5: 2, 0: 2, 5: 1, 15: 1, 20: 1, 25: 1, 30: 1}


def test_first_seen_within_a_day(spark, tmp_path):
    frames = [[("a", START), ("b", START)], [("a", START + dt.timedelta(hours=1)), ("c", START)]]
    stream = counters.first_seen(stream_of(spark, tmp_path, frames, "id string, updated_at timestamp"))
    q = stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp"))
    q.outputMode("append").trigger(availableNow=True).start().awaitTermination()
    assert sorted(r["id"] for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["a", "b", "c"]


def test_lifecycle_stream_equals_batch(spark, tmp_path, rows):
    ev = lambda j, k, t, s, p, m: (j, k, ts(t), s, p, m)
    frames = [
        [ev("1", "start", "2025-01-01", None, None, None), ev("2", "end", "2025-01-01", "SUCCESS", None, "ok")],
        [ev("1", "progress", "2025-01-01 00:01:00", "RUNNING", 5, "p")],
        [ev("1", "end", "2025-01-01 00:02:00", "FAILED", None, "x"), ev("2", "start", "2024-12-31", None, None, None)],
    ]
    schema = "job_id string, kind string, ts timestamp, status string, progress int, message string"
    run_lifecycle(stream_of(spark, tmp_path, frames, schema), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    batch = lifecycle(spark.createDataFrame([r for f in frames for r in f], schema))
    assert rows(read_jobs(spark, str(tmp_path / "out")), "job_id") == rows(batch, "job_id")


def test_shared_dir_follows_the_cluster_setting(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    one, two = shared_dir(spark, "x"), shared_dir(spark, "x")
    assert one != two and one.startswith(base + "/adlake/x-")


def test_shared_dir_refuses_a_local_folder_on_a_cluster():
    class Settings:
        def get(self, key, default):
            return default

    class Session:
        conf = Settings()
        sparkContext = type("C", (), {"master": "yarn"})

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(Session(), "x")
