"""Rate-limit summaries read from raw answer headers, and the decision they lead to."""

import json

from adlake.operators import usage

SCHEMA = "batch_id long, request_index int, status_code int, error_code int, error_subcode int, headers array<struct<name: string, value: string>>"


def head(name, value):
    return {"name": name, "value": value if isinstance(value, str) else json.dumps(value)}


def test_last_header_wins_and_unknown_accounts(spark, rows):
    case = {"type": "ads_insights", "call_count": 200, "total_cputime": 10, "total_time": 20, "estimated_time_to_regain_access": 7}
    answers = [
        (1, 0, 200, None, None, [head("X-FB-Ads-Insights-Throttle", {"app_id_util_pct": 99, "acc_id_util_pct": 80}),
                                 head("X-Business-Use-Case-Usage", {"123": [case], "9": []})]),
        (1, 1, 200, None, None, [head("x-fb-ads-insights-throttle", {"app_id_util_pct": 10}), head("x-fb-ads-insights-throttle", "{broken"),
                                 head("x-business-use-case-usage", {"123": [{**case, "estimated_time_to_regain_access": 2}]})]),
        (2, 0, 200, None, None, [head("x-fb-ads-insights-throttle", {"app_id_util_pct": 96, "acc_id_util_pct": 1})]),
        (3, 0, 200, None, None, [head("x-business-use-case-usage", "not json")]),
    ]
    frame = spark.createDataFrame(answers, SCHEMA)
    got = {r["batch_id"]: r["rate_limits"] for r in rows(usage.summaries_from_headers(frame))}
    # batch 1: the second answer's throttle header does not parse, so the first one's app usage stands
    assert got[1]["app_usage_pct"] == 99.0
    accounts = {a["account_id"]: a for a in got[1]["account_details"]}
    assert set(accounts) == {"act_123", "act_9"}
    assert accounts["act_123"]["eta_seconds"] == 2 and accounts["act_123"]["insights_usage_pct"] is None
    assert accounts["act_9"]["insights_usage_pct"] == 80.0 and accounts["act_9"]["business_use_cases"] == []
    assert got[2]["app_usage_pct"] == 96.0 and got[2]["account_details"] == []
    assert got[3]["app_usage_pct"] == 0.0 and got[3]["account_details"] == []

    decided = {r["batch_id"]: (r["summary_wait"], r["action"], r["seconds"]) for r in rows(usage.batch_decision(usage.with_errors(frame), usage.summaries_from_headers(frame)))}
    # batch 1: 99 % app usage asks 300 s, the fast use case 60 s; batch 2: 96 % asks 300 s
    assert decided == {1: (300, "wait", 305), 2: (300, "wait", 305), 3: (0, "none", 0)}
