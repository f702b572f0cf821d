"""Imports every query module so their ``@register`` calls run."""

from . import (q_customers, q_incremental, q_kpis, q_marketing, q_ml, q_products,  # noqa: F401
               q_quality, q_silver, q_sources, q_streaming)
from . import q_dashboards, q_views  # noqa: F401,E402  (needs the gold queries above)
from .catalog import ORACLE, QUERIES  # noqa: F401
