"""Row and batch numbers in list order, at any partition count."""

import pytest

from adlake.operators import sets


@pytest.mark.parametrize("parts", [1, 3, 7])
def test_batches_follow_the_order_at_any_partition_count(spark, parts):
    ids = spark.range(0, 1000).selectExpr("(id * 7919) % 1000 AS k").repartition(parts)
    got = {r["k"]: r["batch_id"] for r in sets.with_batch_in_order(ids, "k", 35).collect()}
    assert got == {k: k // 35 for k in range(1000)}


def test_numbers_of_an_empty_frame(spark):
    empty = spark.range(0).selectExpr("id AS k")
    assert sets.numbered(empty, ["k"]).count() == 0
