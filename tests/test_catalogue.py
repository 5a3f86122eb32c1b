"""Metrics pivoted over a catalogue table."""

from adlake.operators.pivot import catalogue_pivot

PAYLOAD = "id string, p struct<actions: array<struct<action_type: string, value: string>>, video: array<struct<action_type: string, value: string>>>"


def test_first_entry_by_position_and_zero_fill(spark, rows):
    acts = lambda *pairs: [{"action_type": a, "value": v} for a, v in pairs]
    df = spark.createDataFrame(
        [("r1", {"actions": acts(("like", "3"), ("like", "9"), ("view", "x")), "video": acts(("play", "2"))}),
         ("r2", {"actions": None, "video": []})],
        PAYLOAD,
    )
    catalogue = spark.createDataFrame(
        [("likes", "actions", "like"), ("views", "actions", "view"), ("plays", "video", "play"), ("likes", "actions", "like")],
        "name string, parent string, action_type string",
    )
    got = rows(catalogue_pivot(df, ["id"], "p", catalogue), "id")
    assert got == [{"id": "r1", "likes": 3.0, "plays": 2.0, "views": 0.0}, {"id": "r2", "likes": 0.0, "plays": 0.0, "views": 0.0}]
    fewer = catalogue.filter("name = 'plays'")
    assert catalogue_pivot(df, ["id"], "p", fewer).columns == ["id", "plays"]
