"""Shop reports: creatives and products of a campaign, from flat performance rows.

The rows stay flat all the way: attaching creatives to products to campaigns and
taking them apart again would only build arrays as long as the busiest product.
``flatten_creatives`` in ``operators.unnest`` reads documents that arrive nested.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlake.functions import text as tx
from adlake.functions.jsonx import first_filled
from adlake.operators import enrich, sets
from adlake.operators.latest import last_wins

CONTEXT = ("start_date", "end_date", "advertiser_id", "advertiser_name", "store_id", "store_name")


def creative_report(
    campaigns: DataFrame, products: DataFrame, creatives: DataFrame, catalog: DataFrame, metadata: DataFrame,
    metrics: Sequence[str],
) -> DataFrame:
    """One row per creative that cost or sold something.

    campaigns: campaign_id, campaign_name, operation_status and the context columns.
    products: campaign_id, item_group_id. creatives: the same plus item_id and the
    metrics. metadata: creative texts per (campaign, product, item).
    """
    known = sets.only_known(products.select("campaign_id", "item_group_id"), campaigns, ["campaign_id"])
    active = enrich.drop_idle(creatives)
    # the creatives' texts come first and the campaigns' columns last: the shuffles of the large joins
    # then carry ids and metrics, and not what the joins after them add to every row
    rows = known.join(active, ["campaign_id", "item_group_id"])
    rows = rows.join(metadata, ["campaign_id", "item_group_id", "item_id"], "left")
    rows = enrich.join_catalog(rows, catalog, "item_group_id", "seq")
    rows = rows.join(campaigns, "campaign_id")
    context = [c for c in CONTEXT if c in campaigns.columns]
    return rows.select(
        *context,
        "campaign_id",
        "campaign_name",
        "operation_status",
        "item_group_id",
        F.col("product_title").alias("product_name"),
        "product_status",
        "product_image_url",
        "item_id",
        F.concat(F.lit(tx.VIDEO_LINK), F.col("item_id")).alias("video_url"),
        "title",
        "tt_account_name",
        "tt_account_profile_image_url",
        first_filled(F.col("product_img"), default=F.col("product_image_url")).alias("product_img"),
        *metrics,
    )


def product_report(campaigns: DataFrame, performance: DataFrame, catalog: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """One row per campaign, product and day; products the catalog lacks say so in their name."""
    rows = performance.join(campaigns, "campaign_id")
    rows = enrich.join_catalog(rows, catalog, "item_group_id", "seq", note_missing=True)
    context = [c for c in CONTEXT if c in campaigns.columns]
    return rows.select(
        *context,
        "campaign_id",
        "campaign_name",
        "operation_status",
        "bid_type",
        "item_group_id",
        "stat_time_day",
        F.col("product_title").alias("product_name"),
        "product_image_url",
        "product_status",
        F.col("product_image_url").alias("product_img"),
        *metrics,
    )


def campaign_attributes(rows: DataFrame, seq: str) -> DataFrame:
    """Campaign attributes by id, the last row counting."""
    return last_wins(rows, ["campaign_id"], seq).drop(seq)
