"""Silver layers built lazily from the driver tables.

Each property is a lazy DataFrame plan; nothing runs until an action, but for the
count of the line items, which says how many tasks they are dealt to.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from ..operators import funnel as fn
from ..operators import marketing as mk
from ..operators import orders as od
from ..operators.sessions import enrich_sessions
from ..sources import adapters as ad
from ..sources.driver import read_table


class _World:
    """One lazy plan set per (session, data folder): building the DataFrame
    objects (Python -> JVM expression trees, eager analysis) is done once and
    shared by every query over the same folder. Only plans are shared —
    every action still executes in full."""

    _cache: dict = {}
    KEPT = 8  # the least lately made ones go

    def __new__(cls, spark: SparkSession, sf_dir: str):
        key = (cls.__name__, spark.sparkContext.applicationId, sf_dir)
        inst = cls._cache.get(key)
        if inst is None or inst.spark is not spark:  # plans belong to their session
            while len(cls._cache) >= cls.KEPT:
                cls._cache.pop(next(iter(cls._cache)))
            inst = super().__new__(cls)
            inst.spark, inst.sf_dir = spark, sf_dir
            cls._cache[key] = inst
        return inst

    def __init__(self, spark: SparkSession, sf_dir: str):
        pass


class ClickWorld(_World):
    """Sessions, pageviews and purchase orders from ``events``."""

    @cached_property
    def events(self) -> DataFrame:
        return ad.click_events(read_table(
            self.spark, self.sf_dir, "events",
            ["event_id", "ts", "user_id", "event_type", "value", "props"]))

    @cached_property
    def pageviews(self) -> DataFrame:
        return ad.pageviews(self.events)

    @cached_property
    def raw_sessions(self) -> DataFrame:
        return ad.raw_sessions(self.events)

    @cached_property
    def sessions(self) -> DataFrame:
        return enrich_sessions(self.raw_sessions)

    @cached_property
    def visits(self) -> DataFrame:
        return ad.spread_visits(self.raw_sessions, self.raw_orders)

    @cached_property
    def funnel(self) -> DataFrame:
        return fn.funnel_steps(self.pageviews)

    @cached_property
    def entry_pages(self) -> DataFrame:
        return fn.entry_pages(self.pageviews)

    @cached_property
    def raw_orders(self) -> DataFrame:
        return ad.click_orders(self.events)

    @cached_property
    def items(self) -> DataFrame:
        return ad.click_items(self.events)

    @cached_property
    def refunds(self) -> DataFrame:
        return ad.click_refunds(self.events)

    @cached_property
    def products(self) -> DataFrame:
        return ad.click_products(self.events)

    @cached_property
    def orders(self) -> DataFrame:
        return od.enrich_orders(self.raw_orders, self.items, self.refunds,
                                od.session_attribution(self.sessions), self.products)

    @cached_property
    def items_enriched(self) -> DataFrame:
        return od.enrich_items(self.items, self.products, self.refunds)

    @cached_property
    def sessions_with_orders(self) -> DataFrame:
        return mk.sessions_with_orders(self.sessions, self.funnel, self.orders)


class CommerceWorld(_World):
    """Orders, line items, refunds and brands from the star schema."""

    def _t(self, name, cols):
        return read_table(self.spark, self.sf_dir, name, cols)

    @cached_property
    def tasks(self) -> int | None:
        """Tasks for the line items, by their number (which parquet files state)."""
        return ad.line_tasks(self._t("lineitem", ["l_orderkey"]).count(),
                             int(self.spark.conf.get("spark.sql.shuffle.partitions")))

    @cached_property
    def items(self) -> DataFrame:
        return ad.commerce_items(
            self._t("lineitem", ["l_orderkey"] + ad.LINE_ORDER),
            self._t("orders", ["o_orderkey", "o_orderdate"]),
            self._t("part", ["p_partkey", "p_brand"]), self.tasks)

    @cached_property
    def rollup(self) -> DataFrame:
        return ad.commerce_rollup(ad.commerce_lines(
            self._t("lineitem", ["l_orderkey"] + ad.LINE_ORDER),
            self._t("part", ["p_partkey", "p_brand"]), self.tasks))

    @cached_property
    def raw_orders(self) -> DataFrame:
        return ad.commerce_orders(self._t("orders", ["o_orderkey", "o_custkey", "o_orderdate"]),
                                  self.rollup, self.tasks)

    @cached_property
    def refunds(self) -> DataFrame:
        return ad.commerce_refunds(self.items)

    @cached_property
    def products(self) -> DataFrame:
        return ad.commerce_products(self.items)

    @cached_property
    def attribution(self) -> DataFrame:
        return ad.commerce_attribution(self._t("customer", ["c_custkey", "c_mktsegment"]))

    @cached_property
    def orders(self) -> DataFrame:
        return od.enrich_orders(self.raw_orders, None, None, self.attribution, self.products,
                                attribution_key="user_id")

    @cached_property
    def items_enriched(self) -> DataFrame:
        return od.enrich_items(self.items, self.products)
