"""Mixing sources to target weights by fitting word budgets.

Sources in order of code points (null last) weigh 3, 1, 2, repeating, and share ``share`` times
all words; a target stops at ``cap`` times its source's words and the excess is shared anew. Each
source then takes whole documents: as many full rounds as fit, and for the rest a subset whose
lengths are fitted by subset sum. Documents are counted by exact length, every length gives its
share rounded down, and the remaining budget is closed by a bounded-knapsack search over the
documents left per length. Which documents of a length are taken follows a seeded hash.

Only lengths and hashes are shuffled for this; a source or length with a third of all rows is cut
by hash before it is ranked. Decisions are one row per source and length. Null texts have no
words; documents without words are taken 0 words. Rows that agree in id and text share a hash;
where the last documents taken of a length are some of such rows, equal rows are counted and as many
copies are taken as are due. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window as W, functions as F, types as T

from ..session import cut

WEIGHTS = (3, 1, 2)


@F.pandas_udf(T.LongType())
def n_words(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Runs of characters outside [\\x20\\x09-\\x0D]; null has none."""
    for s in texts:
        yield pd.Series([0 if t is None else len(t.encode().split()) for t in s], dtype="int64")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5,
            cap: float = 2.0) -> DataFrame:
    """``(src, source_size, target)`` from ``(src, source_size)``.

    Sources are filled by level: sorted by how soon they reach their cap, a source is capped when
    the level of the sources not yet capped would lift it above. One row per source."""
    n = len(weights)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]),
                          (F.pmod(F.row_number().over(W.orderBy("src")) - 1, F.lit(n)) + 1)
                          .cast("int")).cast("double")
    first = W.orderBy("_reach", "src")
    before, after = first.rowsBetween(W.unboundedPreceding, -1), first.rowsBetween(
        0, W.unboundedFollowing)
    rows = sizes.withColumn("_w", weight).withColumn("_cap", F.col("source_size") * cap)
    rows = rows.withColumn("_reach", F.col("_cap") / F.col("_w"))
    whole = W.partitionBy()
    level = ((F.sum("source_size").over(whole) * share
              - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))) / F.sum("_w").over(after))
    rows = rows.withColumn("_level", level)
    open_level = F.max(F.when(F.col("_reach") > F.col("_level"), F.col("_level"))).over(whole)
    rows = rows.withColumn("_open", open_level)
    return rows.select("src", "source_size", F.when(
        F.col("_open").isNull() | (F.col("_reach") <= F.col("_open")), F.col("_cap"))
        .otherwise(F.col("_open") * F.col("_w")).alias("target"))


def close_budget(rest: int, lengths: np.ndarray, spare: np.ndarray) -> np.ndarray:
    """How many of each length add up to ``rest`` exactly, or to the next sum below.

    Bounded knapsack over a bit set of reachable sums: a length with ``k`` spare documents enters
    as 1, 2, 4 ... of them. Lengths enter in a fixed random order, so none is preferred, and the
    search ends at the first item that reaches ``rest``."""
    taken = np.zeros(len(lengths), "int64")
    full = (1 << (rest + 1)) - 1
    reach, trail = 1, []
    for i in np.random.default_rng(len(lengths)).permutation(len(lengths)):
        length, left, step = int(lengths[i]), int(spare[i]), 1
        if length <= 0 or length > rest:
            continue
        while left > 0 and not reach >> rest & 1:
            many = min(step, left)
            if many * length > rest:
                many = rest // length
                left = many
            trail.append((i, many, reach))
            reach |= reach << many * length & full
            left -= many
            step *= 2
        if reach >> rest & 1:
            break
    at = reach.bit_length() - 1
    for i, many, before in reversed(trail):
        if not before >> at & 1:
            taken[i] += many
            at -= many * int(lengths[i])
    return taken


def fit(lengths: np.ndarray, counts: np.ndarray, target: float, slack: int = 1 << 17
        ) -> tuple[int, np.ndarray]:
    """``(rounds, extra)``: all documents ``rounds`` times, and ``extra`` more of each length.

    The last ``slack`` words (all words of a small source) are left to the search."""
    total = int((lengths * counts).sum())
    if not total:
        return 0, np.zeros(len(lengths), "int64")
    goal = int(round(target))
    rounds, rest = divmod(goal, total)
    part = max(0, rest - slack)
    extra = (counts.astype(object) * part // total).astype("int64")
    left = rest - int((lengths * extra).sum())
    spare = counts - extra
    order = np.argsort(-(counts.astype(object) * part % total).astype("float64"), kind="stable")
    order = order[(spare[order] > 0) & (lengths[order] > 0)]
    more = order[np.cumsum(lengths[order]) <= left - slack]
    extra[more] += 1
    left -= int(lengths[more].sum())
    extra += close_budget(left, lengths, counts - extra)
    return rounds, extra


def _fit_source(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("size")
    rounds, extra = fit(pdf["size"].to_numpy(), pdf["n"].to_numpy(), pdf["target"].iloc[0])
    return pd.DataFrame({"src": pdf["src"], "size": pdf["size"], "rounds": rounds,
                         "extra": extra, "source_size": pdf["source_size"],
                         "target": pdf["target"]})


def mix(docs: DataFrame, seed: int = 7, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5,
        cap: float = 2.0, salts: int = 256) -> DataFrame:
    """``(row, size, source_size, target, repeats)``: ``row`` holds the columns of ``docs``."""
    src = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("~"))
    keyed = docs.select(
        F.struct(*[F.col(c) for c in docs.columns]).alias("row"), src.alias("src"),
        n_words("text").alias("size"),
        F.xxhash64(F.lit(seed), "doc_id", "text").alias("h"))
    slim = cut(keyed.select("src", "size", "h"))
    by_length = slim.groupBy("src", "size").agg(F.count(F.lit(1)).alias("n"))
    sizes = by_length.groupBy("src").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    fitted = cut(by_length.join(targets(sizes, weights, share, cap), "src").groupBy("src")
                 .applyInPandas(_fit_source, "src string, size long, rounds long, extra long, "
                                             "source_size long, target double"))
    key = ["src", "size"]
    salted = slim.withColumn("salt", F.pmod(F.shiftright("h", 32), F.lit(salts)))
    parts = salted.groupBy(*key, "salt").agg(F.count(F.lit(1)).alias("n"))
    before = W.partitionBy(*key).orderBy("salt").rowsBetween(W.unboundedPreceding, -1)
    parts = (parts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
             .join(fitted.select(*key, "extra"), key)
             .where("extra > before")
             .withColumn("here", F.least(F.col("extra") - F.col("before"), F.col("n"))))
    edge = parts.where("here < n").select(*key, "salt", "here")
    upto = F.sum("n").over(W.partitionBy(*key, "salt").orderBy("h"))
    last = (salted.join(edge, [*key, "salt"]).groupBy(*key, "salt", "here", "h")
            .agg(F.count(F.lit(1)).alias("n")).withColumn("due", F.col("here") - upto + F.col("n"))
            .where("due between 1 and n")
            .select(*key, F.col("salt").alias("edge_salt"), F.col("h").alias("edge_h"), "due",
                    (F.col("due") < F.col("n")).alias("some")))
    full = parts.where("here = n").groupBy(*key).agg(F.max("salt").alias("full_salt"))
    chosen = cut(fitted.join(full, key, "left").join(last, key, "left"))
    salt = F.pmod(F.shiftright("h", 32), F.lit(salts))
    at_edge = F.coalesce((salt == F.col("edge_salt")) & (F.col("h") == F.col("edge_h"))
                         & F.col("some"), F.lit(False))
    more = (F.coalesce(salt <= F.col("full_salt"), F.lit(False))
            | F.coalesce((salt == F.col("edge_salt")) & (F.col("h") <= F.col("edge_h")),
                         F.lit(False)))
    met = keyed.join(chosen, key)
    out = ["row", "size", "source_size", "target"]
    if chosen.where("some").isEmpty():
        return met.select(*out, (F.col("rounds") + more.cast("long")).alias("repeats"))
    # Equal rows of which some are due: a row each of them with its count, numbered, then copied.
    taken = F.sum("n").over(W.partitionBy(*key).orderBy(F.xxhash64("row"))
                            .rowsBetween(W.unboundedPreceding, -1))
    ties = (met.where(at_edge).groupBy("row", *key, "source_size", "target", "rounds", "due")
            .agg(F.count(F.lit(1)).alias("n")).withColumn("before", F.coalesce(taken, F.lit(0)))
            .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n").cast("int")))))
    due = (F.col("before") + F.col("copy") <= F.col("due")).cast("long")
    return (met.where(~at_edge).select(*out, (F.col("rounds") + more.cast("long"))
                                       .alias("repeats"))
            .unionByName(ties.select(*out, (F.col("rounds") + due).alias("repeats"))))
