"""Best matches under a score that no equi-join key can express.

Both sides are cut into blocks by a hash of their unique id. Each pair of blocks is one bounded
task that scores in numpy and lets only the ``k`` best per left row out; the lists are merged by a
ranked window. Nothing is collected or broadcast and no pair table ever exists. Work grows with
rows(left) x rows(right), which exact matching under such a score cannot avoid, and is spread over
blocks(left) x blocks(right) tasks.

Where a block's summary bounds the score of every row in it, ``bounded_best`` visits only the block
pairs that can still matter, and finds the same rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..session import cut
from .shapes import top_rows

#: ``scorer(left_block, right_block) -> (left_index, right_index, score)`` arrays.
Scorer = Callable[[pd.DataFrame, pd.DataFrame], tuple[np.ndarray, np.ndarray, np.ndarray]]


def _blocks(rows: int, size: int) -> int:
    return max(1, math.ceil(rows / size))


def _spread(df: DataFrame, key: str, own: str, n_own: int, other: str, n_other: int) -> DataFrame:
    block = F.pmod(F.xxhash64(key), F.lit(n_own)).cast("int")
    others = F.explode(F.sequence(F.lit(0), F.lit(n_other - 1)))
    return df.withColumn(own, block).withColumn(other, others)


def block_best(left: DataFrame, right: DataFrame, *, left_id: str, right_id: str,
               scorer: Scorer, k: int, block_rows: tuple[int, int] = (1024, 8192),
               rows: tuple[int, int] | None = None) -> DataFrame:
    """``(left_id, right_id, score, rank)`` of the ``k`` best right rows per left row.

    Ids must be unique on their side and named differently. Ties go to the smaller right id.
    ``rows`` gives both row counts where the caller knows them; otherwise they are counted."""
    n_left, n_right = rows or (left.count(), right.count())
    lefts, rights = _blocks(n_left, block_rows[0]), _blocks(n_right, block_rows[1])
    left_type = left.schema[left_id].dataType
    right_type = right.schema[right_id].dataType
    schema = T.StructType([T.StructField(left_id, left_type), T.StructField(right_id, right_type),
                           T.StructField("score", T.DoubleType())])

    def best(lpdf: pd.DataFrame, rpdf: pd.DataFrame) -> pd.DataFrame:
        if lpdf.empty or rpdf.empty:
            return pd.DataFrame({f.name: [] for f in schema})
        lpdf, rpdf = lpdf.reset_index(drop=True), rpdf.reset_index(drop=True)
        li, ri, score = scorer(lpdf, rpdf)
        found = pd.DataFrame({left_id: lpdf[left_id].to_numpy()[li],
                              right_id: rpdf[right_id].to_numpy()[ri], "score": score})
        found = found.sort_values([left_id, "score", right_id], ascending=[True, False, True])
        return found.groupby(left_id, sort=False).head(k)

    lefted = _spread(left, left_id, "_lb", lefts, "_rb", rights)
    righted = _spread(right, right_id, "_rb", rights, "_lb", lefts)
    local = (lefted.groupBy("_lb", "_rb").cogroup(righted.groupBy("_lb", "_rb"))
             .applyInPandas(best, schema))
    return top_rows(local, [left_id], [F.desc("score"), F.asc(right_id)], k)


def block_best_within(left: DataFrame, right: DataFrame, *, on: str, left_id: str, right_id: str,
                      scorer: Callable[[pd.DataFrame, pd.DataFrame],
                                       tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]],
                      block_rows: tuple[int, int] = (256, 2048)) -> DataFrame:
    """Best matches among rows that agree on ``on``: ``(left_id, right_id, score)``.

    The scorer also gives each pair a small class number; one best pair per left row and class
    leaves each block. A value of ``on`` shared by very many rows is cut into as many blocks as
    its counts ask for, so it is spread over tasks and its pairs are never written out."""
    def sized(df: DataFrame, size: int, name: str) -> DataFrame:
        return df.groupBy(on).agg(F.ceil(F.count(F.lit(1)) / F.lit(size)).cast("int").alias(name))

    counts = sized(left, block_rows[0], "_nl").join(sized(right, block_rows[1], "_nr"), on)
    lefted = left.join(counts, on).withColumns({
        "_lb": F.pmod(F.xxhash64(left_id), F.col("_nl")).cast("int"),
        "_rb": F.explode(F.sequence(F.lit(0), F.col("_nr") - 1))}).drop("_nl", "_nr")
    righted = right.join(counts, on).withColumns({
        "_rb": F.pmod(F.xxhash64(right_id), F.col("_nr")).cast("int"),
        "_lb": F.explode(F.sequence(F.lit(0), F.col("_nl") - 1))}).drop("_nl", "_nr")
    schema = T.StructType([T.StructField(left_id, left.schema[left_id].dataType),
                           T.StructField(right_id, right.schema[right_id].dataType),
                           T.StructField("score", T.DoubleType())])

    def best(lpdf: pd.DataFrame, rpdf: pd.DataFrame) -> pd.DataFrame:
        if lpdf.empty or rpdf.empty:
            return pd.DataFrame({f.name: [] for f in schema})
        li, ri, score, kind = scorer(lpdf.reset_index(drop=True), rpdf.reset_index(drop=True))
        found = pd.DataFrame({left_id: lpdf[left_id].to_numpy()[li],
                              right_id: rpdf[right_id].to_numpy()[ri], "score": score,
                              "_kind": kind})
        found = found.sort_values([left_id, "_kind", "score", right_id],
                                  ascending=[True, True, False, True])
        return found.groupby([left_id, "_kind"], sort=False).head(1).drop(columns="_kind")

    keys = (on, "_lb", "_rb")
    return (lefted.groupBy(*keys).cogroup(righted.groupBy(*keys)).applyInPandas(best, schema))


@dataclass
class Visits:
    """Left rows and right blocks that a search brought together, ``(left_id, _rb)``, first by
    their bounds alone and then by what was found, and how many such pairs there are."""

    first: DataFrame
    more: DataFrame
    pairs: int

    def share(self) -> float:
        return (self.first.count() + self.more.count()) / self.pairs


#: Left rows and right summaries that meet in one planning task; blocks that are visited together
#: and visits to them in one task.
PLAN, NEAR, VISIT = (4096, 512), 16, 4096


#: Blocks that one task cuts and one file holds.
HELD = 256


def _numbered(df: DataFrame, order: list[Column], rows: int, size: int) -> tuple[DataFrame, int]:
    """``df`` with a block number ``_rb``, ``size`` rows of one range of ``order`` to a block at
    most, and how many blocks there are. A task sorts many blocks' rows and cuts them in turn."""
    row = F.monotonically_increasing_id()
    # Written, so that blocks stay what they are.
    laid = cut(df.repartitionByRange(_blocks(rows, size * HELD), *order)
               .sortWithinPartitions(*order)
               .withColumn("_range", F.shiftright(row, 33))
               .withColumn("_at", row.bitwiseAND(F.lit((1 << 33) - 1))))
    held = {r["_range"]: r["count"] for r in laid.groupBy("_range").count().collect()}
    before, blocks = [], 0
    for part in range(max(held, default=0) + 1):
        before.append(blocks)
        blocks += -(-held.get(part, 0) // size)
    first = F.array(*map(F.lit, before))[F.col("_range").cast("int")]
    numbered = laid.withColumn("_rb", (first + F.floor(F.col("_at") / size)).cast("int"))
    return numbered.drop("_range", "_at"), max(1, blocks)


def bounded_best(left: DataFrame, right: DataFrame, *, left_id: str, right_id: str,
                 order: list[Column], summarise: Callable[[pd.DataFrame], str],
                 bound: Callable[[pd.DataFrame, list[str]], np.ndarray],
                 scorer: Callable[[pd.DataFrame, pd.DataFrame, np.ndarray],
                                  tuple[np.ndarray, np.ndarray, np.ndarray]],
                 k: int, floor: float, rows: tuple[int, int], block_rows: int = 64,
                 first: int = 2) -> tuple[DataFrame, Visits]:
    """``(left_id, right_id, score, rank)``, the ``k`` best right rows of each left row with a
    score of ``floor`` or more. Ties go to the smaller right id.

    The right side is cut into blocks along ``order``. ``summarise`` tells of a block what
    ``bound`` needs to give, for each left row and block, a score that no row of the block
    exceeds. Each left row first visits the ``first`` blocks with the highest bounds, which sets
    the least score that still matters to it. Then it visits the blocks whose bound is above
    that, or equal with a smaller id in the block, and no others: nothing is lost. ``scorer`` gets
    that least score for each left row. A block that very many rows visit is visited in parts. Ids
    must be unique on their side; scores that differ do so by more than 1e-9."""
    groups = _blocks(rows[0], PLAN[0])
    righted, blocks = _numbered(right, order, rows[1], block_rows)
    chunks = _blocks(blocks, PLAN[1])
    id_type = right.schema[right_id].dataType

    def tell(pdf: pd.DataFrame) -> pd.DataFrame:
        parts = pdf.groupby("_rb")
        return pd.DataFrame([(rb, part[right_id].min(), summarise(part)) for rb, part in parts],
                            columns=["_rb", "_id", "_told"])

    told = cut(righted.groupBy(F.floor(F.col("_rb") / NEAR)).applyInPandas(
        tell, T.StructType([T.StructField("_rb", T.IntegerType()), T.StructField("_id", id_type),
                            T.StructField("_told", T.StringType())])))
    key = left.schema[left_id]
    pair_schema = T.StructType([key, T.StructField("_rb", T.IntegerType()),
                                T.StructField("value", T.DoubleType())])
    schema = T.StructType([key, right.schema[right_id], T.StructField("score", T.DoubleType())])

    def plan(lefts: DataFrame, choose) -> DataFrame:
        """Pairs of left rows and blocks that ``choose`` marks in a matrix of bounds."""
        def pairs(lpdf: pd.DataFrame, mpdf: pd.DataFrame) -> pd.DataFrame:
            if lpdf.empty or mpdf.empty:
                return pd.DataFrame({f.name: [] for f in pair_schema})
            # Neighbours one after another: what bounds them is much alike.
            mpdf = mpdf.sort_values("_rb")
            limits = bound(lpdf, mpdf["_told"].tolist())
            j, i = np.nonzero(choose(limits, lpdf, mpdf).T)
            return pd.DataFrame({left_id: lpdf[left_id].to_numpy()[i],
                                 "_rb": mpdf["_rb"].to_numpy()[j], "value": limits[i, j]})

        spread = lefts.withColumns({
            "_g": F.pmod(F.xxhash64(left_id), F.lit(groups)).cast("int"),
            "_c": F.explode(F.sequence(F.lit(0), F.lit(chunks - 1)))})
        marked = told.withColumns({
            "_c": F.floor(F.col("_rb") / PLAN[1]).cast("int"),
            "_g": F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))})
        return (spread.groupBy("_g", "_c").cogroup(marked.groupBy("_g", "_c"))
                .applyInPandas(pairs, pair_schema))

    def score(lpdf: pd.DataFrame, rpdf: pd.DataFrame) -> pd.DataFrame:
        if lpdf.empty or rpdf.empty:
            return pd.DataFrame({f.name: [] for f in schema})
        hosts, found = dict(list(rpdf.groupby("_rb"))), []
        for rb, come in lpdf.groupby("_rb"):
            li, ri, points = scorer(come, hosts[rb], come["_least"].to_numpy())
            found.append(pd.DataFrame({left_id: come[left_id].to_numpy()[li],
                                       right_id: hosts[rb][right_id].to_numpy()[ri],
                                       "score": points}))
        out = pd.concat(found, ignore_index=True)
        out = out.sort_values([left_id, "score", right_id], ascending=[True, False, True])
        return out.groupby(left_id, sort=False).head(k)

    def visit(lefts: DataFrame, pairs: DataFrame) -> DataFrame:
        near = F.floor(F.col("_rb") / NEAR).cast("int").alias("_near")
        parts = pairs.groupBy(near).agg(
            F.ceil(F.count(F.lit(1)) / F.lit(VISIT)).cast("int").alias("_parts"))
        come = (lefts.join(pairs.select(left_id, "_rb", near), left_id).join(parts, "_near")
                .withColumn("_part", F.pmod(F.xxhash64(left_id), F.col("_parts")).cast("int"))
                .drop("_parts"))
        # New names: both sides of the cogroup come from one count.
        every = parts.select((F.col("_near") + 0).alias("_near"),
                             F.sequence(F.lit(0), F.col("_parts") - 1).alias("_every"))
        host = (righted.withColumn("_near", near).join(every, "_near")
                .withColumn("_part", F.explode("_every")).drop("_every"))
        return (come.groupBy("_near", "_part").cogroup(host.groupBy("_near", "_part"))
                .applyInPandas(score, schema))

    def likely(limits: np.ndarray, lpdf: pd.DataFrame, mpdf: pd.DataFrame) -> np.ndarray:
        marks = np.zeros_like(limits, dtype=bool)
        left_over, every = limits.copy(order="K"), np.arange(len(limits))
        for _ in range(min(first, limits.shape[1])):
            best = left_over.argmax(axis=1)
            marks[every, best], left_over[every, best] = True, -np.inf
        return marks

    def open_still(limits: np.ndarray, lpdf: pd.DataFrame, mpdf: pd.DataFrame) -> np.ndarray:
        least = lpdf["_least"].to_numpy()[:, None]
        marks = limits > least + 1e-9
        # Equal bounds are few beside those below: only there the ids decide.
        j, i = np.nonzero(((limits >= least - 1e-9) & ~marks).T)
        last, own = lpdf["_last"].tolist(), mpdf["_id"].tolist()
        marks[i, j] = [last[a] is None or last[a] != last[a] or own[b] < last[a]
                       for a, b in zip(i.tolist(), j.tolist())]
        return marks

    ranked = [F.desc("value"), F.asc("_rb")]
    early = cut(top_rows(plan(left, likely), [left_id], ranked, first).select(left_id, "_rb"))
    found = cut(visit(left.withColumn("_least", F.lit(float(floor))), early))
    kth = top_rows(found, [left_id], [F.desc("score"), F.asc(right_id)], k).where(
        F.col("rank") == k).select(left_id, F.col("score").alias("_least"),
                                   F.col(right_id).alias("_last"))
    known = cut(left.join(kth, left_id, "left").withColumn(
        "_least", F.coalesce("_least", F.lit(float(floor)))))
    late = cut(plan(known, open_still).select(left_id, "_rb").join(
        early, [left_id, "_rb"], "left_anti"))
    best = top_rows(found.unionByName(visit(known, late)), [left_id],
                    [F.desc("score"), F.asc(right_id)], k)
    return best, Visits(early, late, rows[0] * blocks)
