"""Driver tables -> the canonical shop model.

Two worlds, both derived row-for-row from the given tables so that every
query's work grows with them:

* click world (``events``): one session per (user, day); events become
  pageviews; purchase events become orders with one item each.
* commerce world (``orders``, ``lineitem``, ``part``, ``customer``): orders
  and line items with P&L, returned lines as refunds, brands as products,
  market segment as the acquisition channel.

Canonical column names follow the shop schema (website_session_id,
pageview_url, order_id, price_usd, ...). Money is DECIMAL(18,4).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import MONEY, money

# --- fixed values: adapter rules ----------------------------------------------
SESSION_ID_MULT = 100000          # website_session_id = user_id*MULT + unix day
# entry/landing pages for 'error' events, by k % 4
ENTRY_PAGES = ["/home", "/lander-1", "/lander-2", "/lander-3"]
# product pages for odd-k 'view' events, by (k div 2) % 4; product id = index+1
PRODUCT_PAGES = ["/the-original-mr-fuzzy", "/the-forever-love-bear",
                 "/the-birthday-sugar-panda", "/the-hudson-river-mini-bear"]
PRODUCT_NAMES = ["Product A", "Product B", "Product C", "Product D"]
# (utm_source, utm_campaign, http_referer) of a session, by k % 8 of its
# first event; k >= 50 on rule 0 spells the source ' GSearch' to test PRJ1
CHANNEL_TRIPLES = [
    ("gsearch", "nonbrand", "https://www.gsearch.com"),
    ("gsearch", "brand", "https://www.gsearch.com"),
    ("bsearch", "nonbrand", "https://www.bsearch.com"),
    ("bsearch", "brand", "https://www.bsearch.com"),
    ("socialbook", "desktop_targeted", "https://www.socialbook.com"),
    ("socialbook", "pilot", "https://www.socialbook.com"),
    (None, None, "https://www.gsearch.com"),
    (None, None, None),
]
DEVICES = ["desktop", "mobile"]   # by (k div 8) % 2
CLICK_COGS_RATE = "0.4"           # click-world cogs = value * 0.4
CLICK_REFUND_MIN_K = 90           # purchases with k >= 90 are refunded ...
CLICK_REFUND_DELAY_DAYS = 3       # ... 3 days later, in full
COMMERCE_COGS_BASE = "0.35"       # line cogs = extendedprice * (0.35 + tax)
REFUND_FLAG = "R"
# ------------------------------------------------------------------------------


def _pick(index, values):
    """CASE index WHEN 0 THEN values[0] ... (NULL-safe literals)."""
    expr = None
    for i, v in enumerate(values):
        lit = F.lit(v) if v is not None else F.lit(None).cast("string")
        expr = F.when(index == i, lit) if expr is None else expr.when(index == i, lit)
    return expr


# ----------------------------------------------------------------- click world
def click_events(events: DataFrame) -> DataFrame:
    """events + k, event_date, website_session_id."""
    k = F.get_json_object("props", "$.k").cast("int")
    d = F.to_date("ts")
    return (events.select("event_id", "ts", "user_id", "event_type", "value",
                          k.alias("k"), d.alias("event_date"))
            .withColumn("website_session_id",
                        F.col("user_id") * SESSION_ID_MULT + F.unix_date("event_date")))


def pageview_url(event_type="event_type", k="k"):
    et, kk = F.col(event_type), F.col(k)
    return (F.when(et == "error", _pick(kk % 4, ENTRY_PAGES))
            .when((et == "view") & (kk % 2 == 0), F.lit("/products"))
            .when(et == "view", _pick(F.floor(kk / 2) % 4, PRODUCT_PAGES))
            .when((et == "click") & (kk % 3 == 0), F.lit("/shipping"))
            .when(et == "click", F.lit("/cart"))
            .when((et == "signup") & (kk % 2 == 0), F.lit("/billing"))
            .when(et == "signup", F.lit("/billing-2"))
            .when(et == "purchase", F.lit("/thank-you-for-your-order")))


def pageviews(ev: DataFrame) -> DataFrame:
    """Canonical website_pageviews from ``click_events``."""
    return ev.select(F.col("event_id").alias("website_pageview_id"),
                     F.col("ts").alias("created_at"),
                     "website_session_id", "user_id",
                     pageview_url().alias("pageview_url"))


def raw_sessions(ev: DataFrame) -> DataFrame:
    """Canonical bronze website_sessions: attributes of each session's first
    event (by event_id); is_repeat_session = an earlier day exists for the
    user. Both steps are partial (map-side) aggregations, so a hot user is
    pre-combined before the shuffle."""
    first = (ev.groupBy("website_session_id")
             .agg(F.min(F.struct("event_id", "ts", "k", "user_id", "event_date"))
                  .alias("f")))
    s = first.select("website_session_id", "f.*")
    # the user's first day comes from the (much smaller) session table
    user_first = s.groupBy(F.col("user_id").alias("u")).agg(
        F.min("event_date").alias("user_first_date"))
    k8 = F.col("k") % 8
    src = _pick(k8, [t[0] for t in CHANNEL_TRIPLES])
    src = F.when((k8 == 0) & (F.col("k") >= 50), F.lit(" GSearch")).otherwise(src)
    return (s.join(user_first, s.user_id == user_first.u, "left")
            .select(
                "website_session_id",
                F.col("ts").alias("created_at"),
                "user_id",
                F.when(F.col("event_date") > F.col("user_first_date"), 1)
                .otherwise(0).alias("is_repeat_session"),
                src.alias("utm_source"),
                _pick(k8, [t[1] for t in CHANNEL_TRIPLES]).alias("utm_campaign"),
                F.when(k8 < 6, F.concat(F.lit("ad_"), (F.col("k") % 3 + 1).cast("string")))
                .alias("utm_content"),
                _pick(F.floor(F.col("k") / 8) % 2, DEVICES).alias("device_type"),
                _pick(k8, [t[2] for t in CHANNEL_TRIPLES]).alias("http_referer")))


def _click_product(k="k"):
    return (F.col(k) % 4 + 1).cast("int")


def click_orders(ev: DataFrame) -> DataFrame:
    """Purchase events as orders (one item each)."""
    p = ev.filter(F.col("event_type") == "purchase")
    price = money(F.col("value").cast("decimal(18,2)"))
    return p.select(F.col("event_id").alias("order_id"),
                    F.col("ts").alias("created_at"),
                    "website_session_id", "user_id",
                    _click_product().alias("primary_product_id"),
                    F.lit(1).alias("items_purchased"),
                    price.alias("price_usd"),
                    (price * F.lit(CLICK_COGS_RATE).cast("decimal(4,2)")).cast(MONEY)
                    .alias("cogs_usd"))


def click_items(ev: DataFrame) -> DataFrame:
    o = click_orders(ev)
    return o.select(F.col("order_id").alias("order_item_id"), "created_at",
                    "order_id", F.col("primary_product_id").alias("product_id"),
                    F.lit(1).alias("is_primary_item"), "price_usd", "cogs_usd")


def click_refunds(ev: DataFrame) -> DataFrame:
    p = ev.filter((F.col("event_type") == "purchase") & (F.col("k") >= CLICK_REFUND_MIN_K))
    return p.select(F.col("event_id").alias("order_item_refund_id"),
                    (F.col("ts") + F.make_dt_interval(F.lit(CLICK_REFUND_DELAY_DAYS)))
                    .alias("created_at"),
                    F.col("event_id").alias("order_item_id"),
                    F.col("event_id").alias("order_id"),
                    money(F.col("value").cast("decimal(18,2)")).alias("refund_amount_usd"))


def click_products(ev: DataFrame) -> DataFrame:
    """4 products; launch = first purchase of the product."""
    o = click_orders(ev)
    launch = o.groupBy("primary_product_id").agg(F.min("created_at").alias("created_at"))
    name = _pick(F.col("primary_product_id") - 1, PRODUCT_NAMES)
    return launch.select(F.col("primary_product_id").alias("product_id"),
                         "created_at", name.alias("product_name"))


# --- fixed values: months that click sessions move back to the order history
VISITS_BACK, VISITS_SPREAD = 270, 79
# ---------------------------------------------------------------------------


def spread_visits(sessions: DataFrame, orders: DataFrame) -> DataFrame:
    """Click sessions over the years of the order history (the clicks are one
    month): each user's sessions move back by whole months, VISITS_BACK and the
    user's rest modulo VISITS_SPREAD. Columns session_ts, placed_order."""
    bought = orders.select("website_session_id").distinct().withColumn("_bought", F.lit(1))
    back = F.make_ym_interval(F.lit(0), (F.lit(VISITS_BACK) + F.col("user_id") % VISITS_SPREAD).cast("int"))
    return sessions.join(bought, "website_session_id", "left").select(
        (F.col("created_at").cast("timestamp_ntz") - back).alias("session_ts"),
        F.coalesce("_bought", F.lit(0)).alias("placed_order"))


# -------------------------------------------------------------- commerce world
LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity",
              "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]


#: Lines that a task sorts and rolls up at most, and from how many on AQE no longer joins
#: small partitions (its target is set in packed bytes, which unpack to a GB in a task).
LINES_A_TASK, LINES_DEALT = 1_200_000, 5_000_000


def line_tasks(lines: int, shuffle_partitions: int) -> int | None:
    """How many tasks so many lines are dealt to, so that one holds few enough whatever the
    table's size; None leaves it to AQE."""
    return max(-(-lines // LINES_A_TASK), shuffle_partitions) if lines > LINES_DEALT else None


def _dealt(df: DataFrame, tasks: int | None, key: str) -> DataFrame:
    return df.repartition(tasks, key) if tasks else df.repartition(key)


def _dealt_lines(lineitem: DataFrame, part: DataFrame, tasks: int | None) -> DataFrame:
    li = lineitem.select("l_orderkey", *LINE_ORDER)
    prod = part.select("p_partkey",
                       F.substring_index("p_brand", "#", -1).cast("int").alias("product_id"))
    li = li.join(prod, li.l_partkey == prod.p_partkey, "left").drop("p_partkey")
    return _dealt(li, tasks, "l_orderkey")


def _line_facts(base: DataFrame, created_at) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("l_orderkey").orderBy(*LINE_ORDER))
    ext = F.col("l_extendedprice").cast("decimal(15,2)")
    price = (ext * (F.lit(1).cast("decimal(15,2)") - F.col("l_discount").cast("decimal(15,2)"))).cast(MONEY)
    cogs = (ext * (F.lit(COMMERCE_COGS_BASE).cast("decimal(15,2)") + F.col("l_tax").cast("decimal(15,2)"))).cast(MONEY)
    return (base.withColumn("line_rank", rank)
            .select(F.col("l_orderkey").alias("order_id"),
                    F.col("l_linenumber").alias("line_number"), "line_rank",
                    "product_id",
                    *created_at,
                    F.when(F.col("line_rank") == 1, 1).otherwise(0).alias("is_primary_item"),
                    price.alias("price_usd"), cogs.alias("cogs_usd"),
                    (F.col("l_returnflag") == REFUND_FLAG).alias("is_refunded"),
                    F.col("l_shipdate").alias("refund_ts")))


def commerce_items(lineitem: DataFrame, orders: DataFrame, part: DataFrame, tasks: int | None = None) -> DataFrame:
    """Line items with P&L, product (= brand number) and refund facts.

    ``line_rank`` numbers the lines of an order in LINE_ORDER (equal full rows
    are interchangeable) and ``is_primary_item`` marks the first. Lines whose
    order is absent stay, without an order date, for the data-quality checks.

    Lines are hash-partitioned by order key exactly once, after the part
    lookup, to ``tasks`` tasks; the order join (sort-merge on the same key when orders are too
    big to broadcast), the window and the per-order roll-up downstream all
    run on that one shuffle. A self-join with a ``groupBy`` would prune
    columns differently on its two sides, defeat exchange reuse and scan
    lineitem twice. Group size is one order's basket.
    """
    o = orders.select(F.col("o_orderkey"), F.col("o_orderdate"))
    base = _dealt_lines(lineitem, part, tasks)
    base = base.join(o, base.l_orderkey == o.o_orderkey, "left").drop("o_orderkey")
    return _line_facts(base, [F.col("o_orderdate").alias("created_at")])


def commerce_lines(lineitem: DataFrame, part: DataFrame, tasks: int | None = None) -> DataFrame:
    """``commerce_items`` without the order date: each line once, before orders are joined."""
    return _line_facts(_dealt_lines(lineitem, part, tasks), [])


def commerce_rollup(items: DataFrame) -> DataFrame:
    """Everything orders need from their lines, in ONE aggregate per order:
    line count, price, cogs, primary / cross-sell product and the refund
    roll-up (returned lines are refunded in full). ``items`` are
    ``commerce_lines``: what an order key that comes twice makes of them,
    ``commerce_orders`` adds."""
    r = F.col("is_refunded")
    return items.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("line_item_count"),
        F.sum("price_usd").cast(MONEY).alias("items_price"),
        F.sum("cogs_usd").cast(MONEY).alias("items_cogs"),
        F.max(F.when(F.col("is_primary_item") == 1, F.col("product_id"))).alias("primary_product_id_items"),
        F.max(F.when(F.col("is_primary_item") == 0, F.col("product_id"))).alias("cross_sell_product_id"),
        F.max("product_id").alias("last_product_id"),
        F.sum(F.when(r, F.col("price_usd"))).cast(MONEY).alias("total_refund_usd"),
        F.count(F.when(r, F.lit(1))).alias("_n_ref"),
        F.max(F.when(r, F.col("refund_ts"))).alias("last_refund_ts"),
    ).withColumn("refund_item_count", F.when(F.col("_n_ref") > 0, F.col("_n_ref"))).drop("_n_ref")


def commerce_orders(orders: DataFrame, rollup: DataFrame, tasks: int | None = None) -> DataFrame:
    """Orders priced from their lines (0 when an order has no lines), carrying
    the rest of the roll-up so enrichment needs no second join.

    Lines belong to each row of their order key: where a key comes ``_copies`` times, its
    lines count as often, and the first line's copies are cross-sold beside it. The copies
    are counted by the key that the roll-up is joined on and dealt to the same ``tasks``, so
    orders move once."""
    o = _dealt(orders.select("o_orderkey", "o_custkey", "o_orderdate"), tasks, "o_orderkey")
    o = o.select("*", F.count(F.lit(1)).over(Window.partitionBy("o_orderkey")).alias("_copies"))
    roll = rollup.withColumnRenamed("order_id", "oid")
    n = F.col("_copies").cast("decimal(10,0)")
    return (o.join(roll, o.o_orderkey == roll.oid, "left")
            .select(F.col("o_orderkey").alias("order_id"),
                    F.col("o_orderdate").alias("created_at"),
                    F.lit(None).cast("long").alias("website_session_id"),
                    F.col("o_custkey").alias("user_id"),
                    F.col("primary_product_id_items").alias("primary_product_id"),
                    F.coalesce(F.col("line_item_count") * F.col("_copies"), F.lit(0)).cast("int").alias("items_purchased"),
                    F.coalesce(F.col("items_price") * n, F.lit(0)).cast(MONEY).alias("price_usd"),
                    F.coalesce(F.col("items_cogs") * n, F.lit(0)).cast(MONEY).alias("cogs_usd"),
                    (F.col("line_item_count") * F.col("_copies")).alias("line_item_count"),
                    F.when(F.col("_copies") > 1, F.col("last_product_id"))
                    .otherwise(F.col("cross_sell_product_id")).alias("cross_sell_product_id"),
                    (F.col("total_refund_usd") * n).cast(MONEY).alias("total_refund_usd"),
                    (F.col("refund_item_count") * F.col("_copies")).alias("refund_item_count"), "last_refund_ts"))


def commerce_refunds(items: DataFrame) -> DataFrame:
    return (items.filter("is_refunded")
            .select(F.col("refund_ts").alias("created_at"), "order_id", "line_number",
                    F.col("price_usd").alias("refund_amount_usd")))


def commerce_products(items: DataFrame) -> DataFrame:
    """Brand as product; launch = first order date of any of its lines."""
    return (items.groupBy("product_id").agg(F.min("created_at").alias("created_at"))
            .withColumn("product_name",
                        F.concat(F.lit("Brand#"), F.col("product_id").cast("string"))))


def commerce_attribution(customer: DataFrame) -> DataFrame:
    """Customer market segment as the order's channel (no sessions here)."""
    seg = F.lower(F.col("c_mktsegment"))
    return customer.select(F.col("c_custkey").alias("user_id"),
                           seg.alias("session_channel"),
                           F.initcap(seg).alias("session_channel_group"),
                           F.lit(None).cast("string").alias("session_utm_source"),
                           F.lit(None).cast("string").alias("session_utm_campaign"),
                           F.lit(None).cast("string").alias("session_device_type"),
                           F.lit(None).cast("boolean").alias("session_is_repeat"),
                           seg.alias("acquisition_channel"))
