"""Incremental maintenance of roll-ups: changes of the lines, not the lines, are read.

A roll-up holds a row per key with a row count, sums and a maximum. Counts and sums
follow from the change feed alone: an inserted line (or an update's new row) counts +1,
a deleted one (or an update's old row) -1, and the sums of the changes per key are
added to the stored row. A maximum can only rise that way; where a line goes that may
have been its key's maximum, that key alone is rolled up again from the lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Kinds of change whose row is there afterwards.
ADDED = ("insert", "update_postimage")


def rollup(lines: DataFrame, keys, count: str, sums: dict[str, Column], top: dict[str, str]) -> DataFrame:
    """The roll-up in full: ``count`` rows, ``sums`` (name: decimal expression over the
    lines) and ``top`` (name: column whose maximum it is; one entry)."""
    (high, source), = top.items()
    return lines.groupBy(*keys).agg(
        F.count(F.lit(1)).alias(count), *[F.sum(e).alias(c) for c, e in sums.items()], F.max(source).alias(high))


def deltas(feed: DataFrame, keys, count: str, sums: dict[str, Column], top: dict[str, str]) -> DataFrame:
    """Change per key: the count's and sums' differences, the highest value that came
    (_up) and that went (_down). Changes are combined before they are shuffled."""
    (_, source), = top.items()
    added = F.col("_change_type").isin(*ADDED)
    sign = F.when(added, 1).otherwise(-1)
    return feed.groupBy(*keys).agg(
        F.sum(sign.cast("long")).alias(f"_d_{count}"),
        *[F.sum(e * sign).alias(f"_d_{c}") for c, e in sums.items()],
        F.max(F.when(added, F.col(source))).alias("_up"), F.max(F.when(~added, F.col(source))).alias("_down"))


def maintained(stored: DataFrame, feed: DataFrame, lines_after: DataFrame, keys, count: str,
               sums: dict[str, Column], top: dict[str, str]) -> DataFrame:
    """The roll-up after the changes of ``feed`` (the lines' columns and _change_type).

    ``stored``: the roll-up before; ``lines_after``: all lines afterwards, of which only
    those of keys whose maximum may have gone are used (a semi-join with these keys).
    Keys without lines leave the roll-up. Null keys are a key of their own.
    """
    keys, ((high, _),) = list(keys), tuple(top.items())
    change = deltas(feed, keys, count, sums, top)
    old = stored.select(*[F.col(k).alias(f"_o_{k}") for k in keys], *[c for c in stored.columns if c not in keys],
                        F.lit(True).alias("_old"))
    same = F.lit(True)
    for k in keys:
        same = same & old[f"_o_{k}"].eqNullSafe(change[k])
    j = old.join(change.withColumn("_new", F.lit(True)), same, "full")
    decimal = {f.name: f.dataType for f in stored.schema.fields}
    moved = j.select(
        *[F.when(F.col("_old"), F.col(f"_o_{k}")).otherwise(F.col(k)).alias(k) for k in keys],
        (F.coalesce(count, F.lit(0)) + F.coalesce(f"_d_{count}", F.lit(0))).alias(count),
        *[F.coalesce(F.try_add(F.col(c), F.col(f"_d_{c}")), F.col(c), F.col(f"_d_{c}")).cast(decimal[c]).alias(c) for c in sums],
        F.greatest(high, "_up").alias(high),
        F.coalesce(F.col("_down") >= F.greatest(high, "_up"), F.lit(False)).alias("_again")).where(F.col(count) > 0)
    sure = moved.where("NOT _again").drop("_again")
    doubt = moved.where("_again").drop("_again", high)
    names = doubt.select(*[F.col(k).alias(f"_k_{k}") for k in keys])
    match = F.lit(True)
    for k in keys:
        match = match & lines_after[k].eqNullSafe(names[f"_k_{k}"])
    (_, source), = top.items()
    tops = lines_after.join(names, match, "left_semi").groupBy(*keys).agg(F.max(source).alias("_top"))
    tops = tops.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_top").alias(high))
    back = F.lit(True)
    for k in keys:
        back = back & doubt[k].eqNullSafe(tops[f"_k_{k}"])
    again = doubt.join(tops, back, "left").select(*stored.columns)
    return sure.select(*stored.columns).unionByName(again.hint("rebalance"))
