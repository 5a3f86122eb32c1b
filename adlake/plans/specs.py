"""What each daily model holds: key, identity columns, scalars and action metrics."""

from __future__ import annotations

from dataclasses import dataclass

from adlake.operators.pivot import Metric

# Output column of each (array, action type) in the six daily models,
# in the order account, campaign, ad set, ad, location, age and gender. A dash means
# that the model does not have the metric.
ACTION_METRICS = """
actions onsite_conversion.total_messaging_connection total_messaging_connection - total_messaging_connection - total_messaging_connection total_messaging_connection
actions onsite_conversion.messaging_welcome_message_view messaging_welcome_message_view onsite_conversion_messaging_welcome_message - onsite_conversion_messaging_welcome_message onsite_conversion_messaging_welcome_message messaging_welcome_message_view
actions onsite_conversion.messaging_first_reply messaging_first_reply - messaging_first_reply - onsite_conversion_messaging_first_reply messaging_first_reply
actions onsite_conversion.messaging_user_depth_2_message_send messaging_user_depth_2_message_send - messaging_user_depth_2_message_send - onsite_conversion_messaging_user_depth_2_message_send messaging_user_depth_2_message_send
actions onsite_conversion.messaging_user_depth_3_message_send messaging_user_depth_3_message_send - - - - -
actions onsite_conversion.messaging_user_depth_5_message_send messaging_user_depth_5_message_send - - - - -
actions onsite_conversion.messaging_conversation_started_7d messaging_conversation_started_7d - messaging_conversation_started_7d - - messaging_conversation_started_7d
actions onsite_conversion.messaging_conversation_replied_7d messaging_conversation_replied_7d - messaging_conversation_replied_7d - onsite_conversion_messaging_conversation_replied_7d messaging_conversation_replied_7d
actions onsite_conversion.messaging_block messaging_block - - - - -
actions onsite_conversion.messaging_order_created_v2 messaging_order_created - - - - -
actions link_click link_clicks - link_clicks - link_clicks link_clicks
actions post_engagement post_engagement_count post_engagement_count post_engagement_count post_engagement_count post_engagement_count post_engagement_count
actions page_engagement page_engagement page_engagement page_engagement page_engagement page_engagement page_engagement
actions post_interaction_gross post_interaction_gross_count - post_interaction_gross_count - post_interaction_gross_count -
actions post_interaction_net post_interaction_net_count - post_interaction_net_count - post_interaction_net_count -
actions comment comment_count comment_count comment_count comment_count comment_count -
actions post_reaction post_reaction_count post_reaction_count post_reaction_count post_reaction_count post_reaction_count -
actions like page_like_count - - - - -
actions post post_share_count - post_share_count - - -
actions photo_view photo_view_count - - - - -
actions onsite_conversion.post_save post_save_count - post_save_count - - -
actions onsite_conversion.post_net_like post_net_like_count - post_net_like_count - onsite_conversion_post_net_like -
actions onsite_conversion.post_unlike post_unlike_count - - - - -
actions video_view video_view_count video_view_count video_view_count video_view_count video_view_count video_view_count
actions landing_page_view landing_page_view_count - - - - -
actions lead lead_count - - - - -
actions onsite_conversion.lead_grouped lead_grouped_count - - - - -
actions omni_purchase purchase_count - - - - -
actions view_content view_content_count - - - - -
actions add_to_cart add_to_cart_count - - - - -
actions initiate_checkout initiate_checkout_count - - - - -
action_values omni_purchase purchase_value - - - - -
action_values add_to_cart add_to_cart_value - - - - -
action_values view_content view_content_value - - - - -
action_values initiate_checkout initiate_checkout_value - - - - -
cost_per_action_type onsite_conversion.total_messaging_connection cost_per_messaging_connection - cost_per_messaging_connection - cost_per_total_messaging_connection cost_per_messaging_connection
cost_per_action_type onsite_conversion.messaging_welcome_message_view cost_per_messaging_welcome_message_view - - - - -
cost_per_action_type onsite_conversion.messaging_first_reply cost_per_messaging_first_reply - cost_per_messaging_first_reply - cost_per_messaging_first_reply -
cost_per_action_type onsite_conversion.messaging_user_depth_2_message_send cost_per_messaging_user_depth_2_message_send - cost_per_messaging_user_depth_2_message_send - cost_per_messaging_user_depth_2_message_send -
cost_per_action_type onsite_conversion.messaging_user_depth_3_message_send cost_per_messaging_user_depth_3_message_send - - - - -
cost_per_action_type onsite_conversion.messaging_user_depth_5_message_send cost_per_messaging_user_depth_5_message_send - - - - -
cost_per_action_type onsite_conversion.messaging_conversation_started_7d cost_per_messaging_conversation_started_7d - cost_per_messaging_conversation_started_7d - - -
cost_per_action_type onsite_conversion.messaging_conversation_replied_7d cost_per_messaging_conversation_replied_7d - cost_per_messaging_conversation_replied_7d - cost_per_messaging_conversation_replied_7d -
cost_per_action_type onsite_conversion.messaging_order_created_v2 cost_per_messaging_order_created - - - - -
cost_per_action_type video_view cost_per_video_view - cost_per_video_view - cost_per_video_view cost_per_video_view
cost_per_action_type link_click cost_per_link_click - cost_per_link_click - cost_per_link_click cost_per_link_click
cost_per_action_type post_engagement cost_per_post_engagement - cost_per_post_engagement - cost_per_post_engagement cost_per_post_engagement
cost_per_action_type page_engagement cost_per_page_engagement - cost_per_page_engagement - cost_per_page_engagement cost_per_page_engagement
cost_per_action_type post_interaction_gross cost_per_post_interaction_gross - cost_per_post_interaction_gross - cost_per_post_interaction_gross -
cost_per_action_type like cost_per_page_like - - - - -
cost_per_action_type landing_page_view cost_per_landing_page_view - - - - -
cost_per_action_type lead cost_per_lead - - - - -
cost_per_action_type omni_purchase cost_per_purchase - - - - -
cost_per_action_type view_content cost_per_view_content - - - - -
cost_per_action_type add_to_cart cost_per_add_to_cart - - - - -
cost_per_action_type initiate_checkout cost_per_initiate_checkout - - - - -
purchase_roas omni_purchase purchase_roas - - - - -
video_p25_watched_actions video_view - - - - - video_p25_count
video_p50_watched_actions video_view - - - - - video_p50_count
video_p75_watched_actions video_view - - - - - video_p75_count
video_play_actions video_view - - - - - video_play_count
video_thruplay_watched_actions video_view - - - - - video_thruplay_count
"""

MODEL_ORDER = ("account", "campaign", "adset", "ad", "location", "age_gender")


def action_types(parent: str) -> tuple[str, ...]:
    lines = [line.split() for line in ACTION_METRICS.strip().splitlines()]
    return tuple(p[1] for p in lines if p[0] == parent)


def action_metrics(model: str) -> tuple[Metric, ...]:
    at = 2 + MODEL_ORDER.index(model)
    lines = [line.split() for line in ACTION_METRICS.strip().splitlines()]
    return tuple(Metric(p[at], p[0], p[1]) for p in lines if p[at] != "-")


@dataclass(frozen=True)
class DailySpec:
    """A daily model. ``key`` names payload fields; ``texts`` maps output to payload field."""

    name: str
    source: str
    model: str
    key: tuple[str, ...]
    texts: tuple[tuple[str, str], ...]
    scalars: tuple[str, ...]
    # payload fields that stand in for an empty one: an ad's insight rows say ad_id,
    # its entity rows say id
    spares: tuple[tuple[str, str], ...] = ()

    @property
    def metrics(self) -> tuple[Metric, ...]:
        return action_metrics(self.model)

    @property
    def parents(self) -> tuple[str, ...]:
        return tuple(dict.fromkeys(m.parent for m in self.metrics))

    @property
    def payload_fields(self) -> tuple[str, ...]:
        names = [f for _, f in self.texts] + list(self.key) + [s for _, s in self.spares]
        names += ["date_start", "date_stop", *self.scalars]
        return tuple(dict.fromkeys(names))


def _same(*names: str) -> tuple[tuple[str, str], ...]:
    return tuple((n, n) for n in names)


# Columns of the daily models.
_COMMON = ("spend", "reach", "impressions", "cpc", "cpm", "ctr", "clicks", "frequency")
_LINK_COST = "cost_per_unique_inline_link_click"

ACCOUNT = DailySpec(
    "stg_account_daily", "raw_fb_account_daily_report_metrics", "account",
    ("account_id", "date_start"),
    _same("account_id", "account_name", "account_currency"),
    (*_COMMON, _LINK_COST),
)
CAMPAIGN = DailySpec(
    "stg_campaign_daily", "raw_fb_campaign_daily_report", "campaign",
    ("campaign_id", "date_start"),
    _same("account_id", "account_name", "campaign_id", "campaign_name"),
    (*_COMMON, _LINK_COST),
)
AD_SET = DailySpec(
    "stg_ad_set_daily", "raw_fb_ad_set_daily_report_metrics", "adset",
    ("adset_id", "date_start"),
    _same("adset_id", "account_id", "account_name"),
    _COMMON,
)
AD = DailySpec(
    "stg_ad_daily", "raw_fb_ad_daily_report_metrics", "ad",
    ("ad_id", "date_start"),
    _same("ad_id", "account_id", "account_name", "campaign_id", "campaign_name"),
    (*_COMMON, _LINK_COST),
    (("ad_id", "id"),),
)
LOCATION = DailySpec(
    "stg_ad_daily_location", "raw_fb_location_detailed_report_metrics", "location",
    ("account_id", "ad_id", "date_start", "region"),
    _same("account_id", "account_name", "ad_id", "region", "country"),
    ("spend", "impressions", "cpc", "cpm", "ctr", "clicks", "inline_link_clicks", "inline_link_click_ctr"),
)
AGE_GENDER = DailySpec(
    "stg_ad_age_gender_daily", "raw_fb_age___gender_detailed_report_metrics", "age_gender",
    ("account_id", "ad_id", "date_start", "age", "gender"),
    _same("account_id", "account_name", "ad_id", "age", "gender"),
    ("spend", "impressions", "reach", "clicks", "ctr", "cpc", "cpm", "frequency",
     "inline_link_clicks", "unique_inline_link_clicks", "inline_link_click_ctr"),
)
DAILY = (ACCOUNT, CAMPAIGN, AD_SET, AD, LOCATION, AGE_GENDER)

# Entity columns (output, payload field) and the templates that feed them.
AD_ENTITY = (
    *_same("id", "name", "campaign_id", "campaign_name", "adset_id", "adset_name", "creative_id", "creative_name",
           "creative_body", "creative_title"),
    ("creative_thumbnail_url", "creative_thumbnail_raw_url"),
    ("creative_link_url", "creative_link"),
    *_same("status", "page_name", "actor_id"),
)
AD_ENTITY_TEMPLATES = ("LOCATION_DETAILED_REPORT", "AGE & GENDER_DETAILED_REPORT", "AD_CREATIVE_DAILY_REPORT")
AD_SET_ENTITY = _same("id", "name", "campaign_id", "campaign_name")
AD_SET_ENTITY_TEMPLATES = ("Ad Set Daily Report",)
