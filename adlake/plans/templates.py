"""Report templates: what a report is about and which fields it may select."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    name: str
    level: str
    breakdowns: tuple[str, ...] = ()
    daily: bool = False


_HOUR = "hourly_stats_aggregated_by_audience_time_zone"

# The report templates, their level, breakdowns and daily increment.
TEMPLATES = (
    Template("Campaign Overview Report", "campaign"),
    Template("Campaign Performance by AGE & GENDER", "campaign", ("age", "gender"), True),
    Template("Campaign Performance by Age", "campaign", ("age",), True),
    Template("Campaign Performance by Gender", "campaign", ("gender",), True),
    Template("Campaign Performance by Platform", "campaign", ("publisher_platform", "platform_position"), True),
    Template("Campaign Performance by Region", "campaign", ("region",), True),
    Template("Campaign Performance by Hour (Audience Time)", "campaign", (_HOUR,), True),
    Template("Ad Set Performance Report", "adset"),
    Template("Ad Performance Report", "ad"),
    Template("Account Daily Report", "account", (), True),
    Template("Campaign Daily Report", "campaign", (), True),
    Template("Ad Set Daily Report", "adset", (), True),
    Template("Ad Daily Report", "ad", (), True),
    Template("Ad Creative Report", "ad"),
    Template("Ad Creative Daily Report", "ad", (), True),
    Template("AGE & GENDER_DETAILED_REPORT", "ad", ("age", "gender"), True),
    Template("LOCATION_DETAILED_REPORT", "ad", ("country", "region"), True),
)

# Statuses an object may have to be reported, and fields every insight request asks for.
EFFECTIVE_STATUSES = {
    "adset": ("ACTIVE", "PAUSED", "CAMPAIGN_PAUSED", "ARCHIVED", "IN_PROCESS", "WITH_ISSUES"),
    "ad": (
        "ACTIVE", "PAUSED", "ADSET_PAUSED", "CAMPAIGN_PAUSED", "WITH_ISSUES", "PENDING_REVIEW", "DISAPPROVED",
        "PREAPPROVED", "IN_PROCESS", "PENDING_BILLING_INFO", "ARCHIVED",
    ),
}
INSIGHT_IDS = ("account_id", "date_start", "date_stop")
CONTAINERS = ("actions", "action_values", "cost_per_action_type", "purchase_roas")


def template(name: str) -> Template:
    for t in TEMPLATES:
        if t.name == name:
            return t
    raise KeyError(f"no template named {name!r}")


def selectable_fields(groups: DataFrame, name: str) -> DataFrame:
    """Fields of a template in first-seen order, each once.

    ``groups`` holds the configuration: template, group_no, fields (an array). A
    template has a handful of groups, so collecting them into one row is bounded.
    """
    mine = groups.filter(F.col("template") == name)
    ordered = mine.agg(F.sort_array(F.collect_list(F.struct("group_no", "fields"))).alias("g"))
    return ordered.select(
        F.posexplode(F.array_distinct(F.flatten(F.transform("g", lambda x: x["fields"])))).alias("position", "field")
    )


def insight_fields(level: str, template_fields: Sequence[str], selected: Sequence[str] = ()) -> list[str]:
    """What an insight request asks for: fixed ids, the template's fields, the raw arrays, the level's id."""
    wanted = [*INSIGHT_IDS, *template_fields, *CONTAINERS, f"{level}_id"]
    wanted += [f for f in selected if f in template_fields]
    return list(dict.fromkeys(wanted))


def project(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Only the named columns that exist; the scan reads nothing else."""
    return df.select(*[n for n in names if n in df.columns])


def reportable(df: DataFrame, level: str, status: Column | None = None) -> DataFrame:
    """Objects in a status the level allows; campaigns have no such list and all pass."""
    allowed = EFFECTIVE_STATUSES.get(level)
    if allowed is None:
        return df
    return df.filter((status if status is not None else F.col("effective_status")).isin(*allowed))


def spending(df: DataFrame, spend: Column | None = None) -> DataFrame:
    return df.filter((spend if spend is not None else F.col("spend")).try_cast("double") > 0)
