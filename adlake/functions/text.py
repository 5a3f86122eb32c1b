"""Names, links and request URLs."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from adlake.functions.jsonx import text

# Text that appears in report cells.
UNKNOWN_PAGE = "Page không xác định"
UNKNOWN_PRODUCT = "Không tìm thấy thông tin cho ID "
STORY_LINK = "https://facebook.com/"
VIDEO_LINK = "https://www.tiktok.com/@user/video/"
API_VERSIONS = ("v23.0", "v24.0", "v25.0")
SHOP_API_VERSION = "/v1.3/"
SHOP_API_HOST = "tiktok.com"


def sanitise(c: Column) -> Column:
    return F.regexp_replace(F.lower(c), "[^a-zA-Z0-9_]", "_")


def sanitise_name(name: str) -> str:
    return re.sub("[^a-zA-Z0-9_]", "_", name.lower())


def raw_table(template: str, suffix: str = "") -> str:
    """Landing table of a report template."""
    return f"raw_fb_{sanitise_name(template)}{suffix}"


def prefixed(prefix: str, c: Column) -> Column:
    """``prefix + c``, or '' when ``c`` is empty."""
    return F.when(text(c) != "", F.concat(F.lit(prefix), c)).otherwise(F.lit(""))


def image_formula(url: Column) -> Column:
    return F.when(text(url) != "", F.concat(F.lit('=IMAGE("'), url, F.lit('")'))).otherwise(F.lit(""))


def short_id(c: Column) -> Column:
    return F.substring(text(c), 1, 8)


def mail_name(c: Column) -> Column:
    return F.split_part(c, F.lit("@"), F.lit(1))


def endpoint_name(url: Column) -> Column:
    """Path after the API version, without a trailing slash; the whole URL if there is none."""
    tail = F.split_part(url, F.lit(SHOP_API_VERSION), F.lit(2))
    return F.regexp_replace(F.when(tail != "", tail).otherwise(url), "/$", "")


# -- query strings -----------------------------------------------------------------


def _encode(c: Column) -> Column:
    # form encoding as browsers and most HTTP clients write it: ~ is kept, * is not
    return F.replace(F.replace(F.url_encode(c), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def _decode(c: Column) -> Column:
    return F.coalesce(F.try_url_decode(c), c)


def query_pairs(query: Column, keep_blank: bool = False) -> Column:
    """``a=1&b=2`` as an array of decoded ``(k, v)`` structs."""
    cut = F.transform(
        F.split(text(query), "&"),
        lambda part: F.struct(
            F.when(F.instr(part, "=") > 0, F.substring_index(part, "=", 1)).otherwise(part).alias("k"),
            F.when(F.instr(part, "=") > 0, part.substr(F.instr(part, "=") + 1, F.length(part)))
            .otherwise(F.lit(""))
            .alias("v"),
        ),
    )
    keep = (lambda p: p["k"] != "") if keep_blank else (lambda p: (p["k"] != "") & (p["v"] != ""))
    return F.transform(
        F.filter(cut, keep), lambda p: F.struct(_decode(p["k"]).alias("k"), _decode(p["v"]).alias("v"))
    )


def query_string(pairs: Column) -> Column:
    """Encoded query text; repeated names are grouped where they first appear."""
    names = F.array_distinct(F.transform(pairs, lambda p: p["k"]))
    grouped = F.flatten(F.transform(names, lambda n: F.filter(pairs, lambda p: p["k"] == n)))
    return F.array_join(F.transform(grouped, lambda p: F.concat(_encode(p["k"]), F.lit("="), _encode(p["v"]))), "&")


def _split_url(url: Column) -> tuple[Column, Column]:
    base = F.substring_index(F.substring_index(url, "#", 1), "?", 1)
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    return base, query


def relative_url(url: Column, drop: tuple[str, ...] = ("access_token",)) -> Column:
    """Host, API version and secret parameters removed, the rest re-encoded."""
    base, query = _split_url(url)
    path = F.regexp_replace(base, r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/]*", "")
    for version in API_VERSIONS:
        path = F.replace(path, F.lit(f"/{version}/"), F.lit(""))
    path = F.regexp_replace(path, "^/+", "")
    rest = query_string(F.filter(query_pairs(query), lambda p: ~p["k"].isin(*drop)))
    return F.when(text(url) == "", F.lit("")).otherwise(
        F.concat(path, F.when(rest != "", F.concat(F.lit("?"), rest)).otherwise(F.lit("")))
    )


def next_page_url(next_url: Column, after: Column, original: Column) -> Column:
    """The page's own ``next`` link; else the request with its cursor moved forward; else NULL."""
    base, query = _split_url(original)
    pairs = query_pairs(query, keep_blank=True)
    cursor = F.struct(F.lit("after").alias("k"), after.alias("v"))
    moved = F.when(
        F.exists(pairs, lambda p: p["k"] == "after"),
        # an existing cursor is replaced where it stands
        F.filter(
            F.transform(pairs, lambda p, i: F.when(p["k"] == "after", F.when(_first_after(pairs) == i, cursor)).otherwise(p)),
            lambda p: p.isNotNull() & (p["k"] != "before"),
        ),
    ).otherwise(F.array_append(F.filter(pairs, lambda p: p["k"] != "before"), cursor))
    fragment = F.regexp_extract(original, "(#.*)$", 1)
    rebuilt = F.concat(base, F.lit("?"), query_string(moved), fragment)
    return F.coalesce(F.nullif(next_url, F.lit("")), F.when(text(after) != "", rebuilt))


def _first_after(pairs: Column) -> Column:
    return (F.array_position(F.transform(pairs, lambda p: p["k"]), F.lit("after")) - 1).cast("int")


_QUOTE = r"(?:['\"]|%27|%22)?"
_DAY = r"(\d{4}-\d{2}-\d{2})"
TIME_RANGE = (
    r"(?i)time_range(?:=|\(|%28)(?:\{|%7B).*?"
    + _QUOTE + "since" + _QUOTE + r"(?::|%3A)[\s+]*" + _QUOTE + _DAY
    + r".*?" + _QUOTE + "until" + _QUOTE + r"(?::|%3A)[\s+]*" + _QUOTE + _DAY
)


def url_since(url: Column) -> Column:
    return F.regexp_extract(url, TIME_RANGE, 1).try_cast("date")


def url_until(url: Column) -> Column:
    return F.regexp_extract(url, TIME_RANGE, 2).try_cast("date")
