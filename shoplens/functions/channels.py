"""Marketing-channel rules (PRJ1, PRJ3, PRJ4, PRJ19).

The rule table is data: ``classify_channel`` folds it into one CASE WHEN,
first match wins.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .exprs import col_

# --- fixed values: channel taxonomy (must equal the source system's) -------
# (utm_source, utm_campaign, marketing_channel), evaluated in this order.
PAID_RULES = [
    ("gsearch", "nonbrand", "paid_search_gsearch_nonbrand"),
    ("gsearch", "brand", "paid_search_gsearch_brand"),
    ("bsearch", "nonbrand", "paid_search_bsearch_nonbrand"),
    ("bsearch", "brand", "paid_search_bsearch_brand"),
    ("socialbook", "desktop_targeted", "social_desktop"),
    ("socialbook", "pilot", "social_pilot"),
]
SEARCH_ENGINES = ["gsearch", "bsearch"]
# channel-group prefixes / names
GROUPS = [
    ("paid_search", "Paid Search"),
    ("social", "Social"),
]
GROUP_EXACT = [
    ("organic_search", "Organic"),
    ("direct", "Direct"),
]
OTHER_GROUP = "Other"
# dashboard display names (PRJ19); anything else: '_' -> ' ', then
# 'paid search' -> 'Paid Search'
DISPLAY_NAMES = {
    "paid_search_gsearch_nonbrand": "Paid Search - gsearch",
    "paid_search_gsearch_brand": "Paid Search - Brand",
    "paid_social_bsearch": "Paid Social - bsearch",
    "direct": "Direct",
    "organic_search": "Organic Search",
}
# ---------------------------------------------------------------------------


def normalise(c, default: str | None = None) -> Column:
    """PRJ1: coalesce(default) -> trim -> lower."""
    x = col_(c)
    if default is not None:
        x = F.coalesce(x, F.lit(default))
    return F.lower(F.trim(x))


def classify_channel(source="utm_source", campaign="utm_campaign",
                     referer="http_referer", rules=PAID_RULES,
                     engines=SEARCH_ENGINES) -> Column:
    """PRJ3: marketing channel from raw (NULL-able) UTM fields.

    Organic (no UTM source, referer from a search engine) is tested before
    direct (no UTM source, no search referer), so both are reachable.
    """
    src = normalise(source)
    cmp_ = normalise(campaign)
    ref = normalise(referer)
    expr = None
    for s, c, name in rules:
        cond = (src == s) & (cmp_ == c)
        expr = F.when(cond, name) if expr is None else expr.when(cond, name)
    no_source = src.isNull() | (src == "") | (src == "none") | (src == "direct")
    from_search = F.lit(False)
    for e in engines:
        from_search = from_search | F.coalesce(ref.contains(e), F.lit(False))
    expr = expr.when(no_source & from_search, "organic_search")
    expr = expr.when(no_source, "direct")
    return expr.otherwise("other")


def channel_group(channel="marketing_channel") -> Column:
    """PRJ4: 5-value channel group."""
    ch = col_(channel)
    expr = None
    for prefix, name in GROUPS:
        cond = ch.startswith(prefix)
        expr = F.when(cond, name) if expr is None else expr.when(cond, name)
    for exact, name in GROUP_EXACT:
        expr = expr.when(ch == exact, name)
    return expr.otherwise(OTHER_GROUP)


def display_name(channel="marketing_channel") -> Column:
    """PRJ19: human label for dashboards."""
    ch = col_(channel)
    expr = None
    for k, v in DISPLAY_NAMES.items():
        expr = F.when(ch == k, v) if expr is None else expr.when(ch == k, v)
    spaced = F.replace(ch, F.lit("_"), F.lit(" "))
    return expr.otherwise(F.replace(spaced, F.lit("paid search"), F.lit("Paid Search")))
