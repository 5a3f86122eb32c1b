"""Quota windows that start with the first call, kept as stream state per key."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

OUTPUT = "key string, call_id string, us bigint, allowed boolean"
STATE = "started array<bigint>, used array<bigint>"


def _decide(times, rules, started, used):
    """Allowed flags for calls in time order; windows and counts are changed in place."""
    flags = []
    for us in times:
        allowed = True
        for i, (limit, period) in enumerate(rules):
            if us >= started[i] + period * 1_000_000:
                started[i], used[i] = us, 0
            used[i] += 1
            if used[i] > limit:
                allowed = False
                break
        flags.append(allowed)
    return flags


def first_hit_quota(calls: DataFrame, key: str, call_id: str, ts: str, rules: Sequence[tuple[int, int]], late: str = "1 minute") -> DataFrame:
    """Whether each call fits every ``(limit, period seconds)`` rule.

    A rule's window opens with its first call and closes ``period`` later. The
    shortest period is tested first, and a call it refuses does not count against
    the longer ones. State is two numbers per rule and key and goes away once all
    windows are over. A task holds one key's calls of one micro-batch, so bound
    the micro-batch at the source (``maxFilesPerTrigger``).
    """
    ordered = sorted(rules, key=lambda r: r[1])
    longest = max(p for _, p in ordered)

    def run(keys: tuple, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        if state.exists:
            started, used = (list(v) for v in state.get)
        else:
            started, used = [-(2**62)] * len(ordered), [0] * len(ordered)
        rows = pd.concat(list(chunks)).sort_values(["us", "call_id"])
        flags = _decide(rows["us"].tolist(), ordered, started, used)
        state.update((started, used))
        over = (max(started) + longest * 1_000_000) // 1000 + 1
        state.setTimeoutTimestamp(max(over, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame({"key": keys[0], "call_id": rows["call_id"], "us": rows["us"], "allowed": flags})

    t = F.col(ts).cast("timestamp")
    slim = calls.select(
        F.col(key).cast("string").alias("key"), F.col(call_id).cast("string").alias("call_id"),
        F.unix_micros(t).alias("us"), t.alias("__ts"),
    ).withWatermark("__ts", late)
    return slim.groupBy("key").applyInPandasWithState(run, OUTPUT, STATE, "append", GroupStateTimeout.EventTimeTimeout)
