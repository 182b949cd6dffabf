"""Chunks of a run's items, found from many places of the run at once."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestack.operators.ranking import placed
from lodestack.session import discard, materialize, unused

#: Items of a stretch; chunks are shorter than that.
STRETCH = 8192


def _ends(rows: pd.DataFrame, own: int, most: int, budget: int) -> np.ndarray:
    """Where a chunk that begins at each of the first ``own`` rows ends: at a change of the model, after ``most`` rows, or before the budget is exceeded; one row always fits."""
    tokens = rows["tokens"].fillna(0).to_numpy(np.int64)
    total = np.cumsum(tokens)
    model = pd.factorize(rows["model"], use_na_sentinel=True)[0]
    change = np.append(np.flatnonzero(model[1:] != model[:-1]) + 1, len(rows))
    at = np.arange(own)
    fits = np.searchsorted(total, total[:own] - tokens[:own] + budget, side="right")
    return np.minimum(np.minimum(at + most, change[np.searchsorted(change, at, side="right")]), np.maximum(fits, at + 1))


def chunks(items: DataFrame, group: str, order: str, most: int, budget: int, stretch: int | None = None) -> DataFrame:
    """items with ``chunk``: each takes the next ones of its group while their model is the same and their number and tokens fit; one always fits.

    items: group, order, tokens, model and more. A chunk depends on where the one before has ended, but a group isn't
    packed from end to end. Groups are cut into stretches. A chunk has ``most`` items at most, so the first chunk
    that begins in a stretch does so at one of its first ``most`` places; each stretch tells for each of those where
    the next stretch would be entered, and after how many chunks. These steps are joined with themselves, so that
    they lead 1, 2, 4, ... stretches on, and the known entries double with each round. Then each stretch numbers its chunks.
    Null tokens count as none; a null model is a model.
    """
    size = max(stretch or STRETCH, most)
    stem = unused(items, "packed")
    place, block, own = f"{stem}_place", f"{stem}_block", f"{stem}_own"
    numbered = materialize(placed(items, [group], [order], place), "chunk-places")
    at = F.col(place) - 1
    first = F.floor(at / size)
    both = F.when((at % size < most) & (first > 0), F.array(F.struct(first.alias("b"), F.lit(True).alias("o")), F.struct((first - 1).alias("b"), F.lit(False).alias("o")))).otherwise(F.array(F.struct(first.alias("b"), F.lit(True).alias("o"))))
    dealt = numbered.withColumn(stem, F.explode(both)).withColumns({block: F.col(f"{stem}.b"), own: F.col(f"{stem}.o")}).drop(stem)
    kind = items.schema[group].dataType.simpleString()

    def steps(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(place, ignore_index=True)
        n = int(pdf[own].sum())
        to, many = _ends(pdf, n, most, budget).tolist(), [1] * n
        for k in range(n - 1, -1, -1):
            if to[k] < n:
                to[k], many[k] = to[to[k]], many[to[k]] + 1
        entries = min(n, most)
        leads = [x if x >= n else n for x in to[:entries]]
        return pd.DataFrame({"g": [pdf[group].iloc[0]] * entries, "block": int(pdf[block].iloc[0]), "entry": range(entries), "to": [x - n for x in leads], "many": many[:entries]})

    jumps = materialize(dealt.select(group, "tokens", "model", place, block, own).groupBy(group, block).applyInPandas(steps, f"g {kind}, block long, entry long, to long, many long"), "chunk-steps")
    known = numbered.select(F.col(group).alias("g")).distinct().select("g", F.lit(0).cast("long").alias("block"), F.lit(0).cast("long").alias("entry"), F.lit(0).cast("long").alias("chunks"))
    reach, written = 1, [jumps]
    stretches = (jumps.agg(F.max("block")).first()[0] or 0) + 1
    for _ in range(math.ceil(math.log2(stretches))):
        led = jumps.select(F.col("g").alias("jg"), F.col("block").alias("jb"), F.col("entry").alias("je"), "to", "many")
        here = F.col("g").eqNullSafe(F.col("jg"))
        further = known.join(led, here & (F.col("block") == F.col("jb")) & (F.col("entry") == F.col("je"))).select("g", (F.col("block") + reach).alias("block"), F.col("to").alias("entry"), (F.col("chunks") + F.col("many")).alias("chunks"))
        known = materialize(known.unionByName(further), "chunk-entries")
        twice = jumps.withColumnsRenamed({"to": "via", "many": "until"}).join(led, here & (F.col("block") + reach == F.col("jb")) & (F.col("via") == F.col("je")))
        jumps = materialize(twice.select("g", "block", "entry", "to", (F.col("until") + F.col("many")).alias("many")), "chunk-steps")
        reach *= 2
        written += [known, jumps]

    def numbers(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left):  # the group has ended before this stretch
            return pd.DataFrame({"g": [], "place": [], "chunk": []})
        left = left.sort_values(place, ignore_index=True)
        n = int(left[own].sum())
        ends = _ends(left, n, most, budget)
        begins = np.zeros(n, bool)
        k = int(right["entry"].iloc[0])
        while k < n:
            begins[k] = True
            k = ends[k]
        return pd.DataFrame({"g": left[group].iloc[:n], "place": left[place].iloc[:n], "chunk": int(right["chunks"].iloc[0]) + np.cumsum(begins) - 1})

    parts = dealt.select(group, "tokens", "model", place, block, own).groupBy(group, block)
    told = parts.cogroup(known.groupBy("g", "block")).applyInPandas(numbers, f"g {kind}, place long, chunk long")
    told = materialize(told, "chunk-numbers")
    discard(*written)
    return numbered.join(told, F.col(group).eqNullSafe(F.col("g")) & (F.col(place) == F.col("place"))).select(*items.columns, "chunk")
