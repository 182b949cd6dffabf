"""Places in an order within groups, where one group may hold all rows.

A window over a group sorts it in one task. Here rows are dealt by ranges of (group, order), so a large group lies
in many partitions. Written once, each row has its partition and its number there; how many rows come before a
partition is the sum of the counts of those before it, which is one row for each partition. So every row has
a place among all, and its place in its group is that less the group's first, which is an aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lodestack.session import materialize, unused

#: Rows of a partition are numbered within so many bits by Spark.
_BITS = 33


def placed(df: DataFrame, within: list[str], order: list[str | Column], name: str = "place", size: str | None = None) -> DataFrame:
    """df with each row's place (long, from 1) among those with the same ``within``, and with ``size`` also how many they are.

    Rows that are equal in ``order`` get places of their own, in any order. Nulls in ``within`` are a group. Without
    ``within`` all rows are one group. What the ranges are made of is sampled by Spark, so the rows are written once.
    """
    stem = unused(df, "rank")
    at, part, before, first, many = (f"{stem}_{k}" for k in ("at", "part", "before", "first", "many"))
    keys = [F.col(c) if isinstance(c, str) else c for c in order]
    by = [F.col(c) for c in within]
    sorted_ = df.repartitionByRange(*by, *keys).sortWithinPartitions(*by, *keys).withColumn(at, F.monotonically_increasing_id())
    held = materialize(sorted_, "ranked").withColumn(part, F.shiftright(at, _BITS))
    counts = held.groupBy(part).agg(F.count(F.lit(1)).alias(many))  # a row for each partition
    ends = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(part, F.coalesce(F.sum(many).over(ends), F.lit(0)).alias(before))
    among_all = held.join(F.broadcast(offsets), part).withColumn(at, F.col(before) + F.col(at) - F.shiftleft(part, _BITS))
    groups = among_all.groupBy(*[F.col(c).alias(f"{stem}_{k}") for k, c in enumerate(within)]).agg(F.min(at).alias(first), F.count(F.lit(1)).alias(many))
    same = [F.col(c).eqNullSafe(F.col(f"{stem}_{k}")) for k, c in enumerate(within)] or [F.lit(True)]
    met = among_all.join(groups if within else F.broadcast(groups), same)
    more = {} if size is None else {size: F.col(many)}
    return met.withColumns({name: F.col(at) - F.col(first) + 1} | more).select(*df.columns, name, *more)
