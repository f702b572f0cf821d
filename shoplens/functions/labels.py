"""Banding / labelling rules as CASE WHEN expressions (PRJ13-PRJ18)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .exprs import col_

# --- fixed values -----------------------------------------------------------
# customer tier on gross lifetime value: >=100 High, >=50 Mid, else single
TIER_BANDS = [(100.0, "High Value"), (50.0, "Mid Value")]
TIER_DEFAULT = "Single Purchase"
# propensity band on predicted probability, right-closed: <=0.10, <=0.30, rest
PROPENSITY_BANDS = [(0.10, "LOW"), (0.30, "MEDIUM")]
PROPENSITY_DEFAULT = "HIGH"
# trend label on a % change: > +5 UP, < -5 DOWN, else (and NULL) STABLE
TREND_THRESHOLD = 5.0
# pipeline health score bands (status, colour)
HEALTH_BANDS = [(95.0, "EXCELLENT", "GREEN"), (85.0, "GOOD", "GREEN"),
                (70.0, "FAIR", "AMBER")]
HEALTH_DEFAULT = ("POOR", "RED")
# scorecard RAG: >=80 GREEN, >=60 AMBER, else RED
RAG_BANDS = [(80.0, "GREEN"), (60.0, "AMBER")]
RAG_DEFAULT = "RED"
# funnel exit step by depth 1..7
EXIT_STEPS = {7: "Converted", 6: "Billing", 5: "Shipping", 4: "Cart",
              3: "Product Page", 2: "Products"}
EXIT_DEFAULT = "Entry Page"
# ----------------------------------------------------------------------------


def _at_least(value, bands, default) -> Column:
    v = col_(value)
    expr = None
    for lo, label in bands:
        expr = F.when(v >= lo, label) if expr is None else expr.when(v >= lo, label)
    return expr.otherwise(default)


def customer_tier(ltv="gross_lifetime_value", bands=TIER_BANDS,
                  default=TIER_DEFAULT) -> Column:
    """PRJ13."""
    return _at_least(ltv, bands, default)


def propensity_band(prob="conversion_prob", bands=PROPENSITY_BANDS,
                    default=PROPENSITY_DEFAULT) -> Column:
    """PRJ14: right-closed bins like ``pd.cut``; NULL stays NULL."""
    p = col_(prob)
    expr = None
    for hi, label in bands:
        expr = F.when(p <= hi, label) if expr is None else expr.when(p <= hi, label)
    return F.when(p.isNull(), None).otherwise(expr.otherwise(default))


def trend_label(change_pct, threshold=TREND_THRESHOLD) -> Column:
    """PRJ15: UP / DOWN / STABLE (NULL -> STABLE)."""
    c = col_(change_pct)
    return (F.when(c > threshold, "UP").when(c < -threshold, "DOWN")
            .otherwise("STABLE"))


def health_status(score="health_score", bands=HEALTH_BANDS,
                  default=HEALTH_DEFAULT) -> Column:
    """PRJ16 status text."""
    return _at_least(score, [(lo, s) for lo, s, _ in bands], default[0])


def health_colour(score="health_score", bands=HEALTH_BANDS,
                  default=HEALTH_DEFAULT) -> Column:
    """PRJ16 colour."""
    return _at_least(score, [(lo, c) for lo, _, c in bands], default[1])


def rag_status(score="composite_score", bands=RAG_BANDS,
               default=RAG_DEFAULT) -> Column:
    """PRJ17."""
    return _at_least(score, bands, default)


def exit_step(depth="funnel_depth", steps=EXIT_STEPS,
              default=EXIT_DEFAULT) -> Column:
    """PRJ18: funnel exit label from depth."""
    d = col_(depth)
    expr = None
    for k in sorted(steps, reverse=True):
        expr = F.when(d == k, steps[k]) if expr is None else expr.when(d == k, steps[k])
    return expr.otherwise(default)
