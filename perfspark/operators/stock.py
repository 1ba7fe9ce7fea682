"""Supplement stock: on hand, catalogue, history and guarded issue.

Stock is never stored; it is receipts minus assignments.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.numbers import exact_sum, num_of, to_int
from ..functions.text import product_label
from ..session import cut

#: Running totals of requests are kept in fixed point, so that they do not depend on the plan. A
#: quantity that it cannot hold is larger than any stock. Differences keep all 15 places.
EXACT = "decimal(36,15)"


def active_products(products: DataFrame) -> DataFrame:
    """Products whose ``active`` is 1, missing or unreadable."""
    flag = to_int("active")
    return products.where(flag.isNull() | (flag == 1))


def _total(df: DataFrame, name: str) -> DataFrame:
    pid = to_int("product_id")
    return (df.where(pid.isNotNull()).groupBy(pid.alias("product_id"))
            .agg(exact_sum(num_of(df, "quantity", 0)).alias(name)))


def on_hand(receipts: DataFrame, assignments: DataFrame) -> DataFrame:
    """``(product_id, received, assigned, on_hand)``; both sides are totalled before they meet."""
    both = _total(receipts, "received").join(_total(assignments, "assigned"),
                                             "product_id", "full")
    got, gone = F.coalesce("received", F.lit(0.0)), F.coalesce("assigned", F.lit(0.0))
    return both.select("product_id", got.alias("received"), gone.alias("assigned"),
                       (got - gone).alias("on_hand"))


def catalogue(products: DataFrame, receipts: DataFrame, assignments: DataFrame, *,
              active_only: bool = True) -> DataFrame:
    """Products with stock and label; in stock first, then by name."""
    rows = active_products(products) if active_only else products
    stock = on_hand(receipts, assignments).select(F.col("product_id").alias("_pid"), "on_hand")
    joined = rows.join(stock, to_int("id") == F.col("_pid"), "left").drop("_pid")
    out = joined.withColumns({"on_hand": F.coalesce("on_hand", F.lit(0.0)),
                              "label": product_label("name", "brand", "unit")})
    return out.orderBy(F.col("on_hand") <= 0, F.coalesce("name", F.lit("")), "id")


def issue_history(assignments: DataFrame, products: DataFrame, *,
                  players: list[int] | None = None) -> DataFrame:
    """Assignments with their product name, newest first."""
    rows = assignments if players is None else assignments.where(
        to_int("sams_player_id").isin(players))
    names = products.groupBy(to_int("id").alias("_pid")).agg(F.max("name").alias("product_name"))
    joined = rows.join(names, to_int("product_id") == F.col("_pid"), "left").drop("_pid")
    # A player's assignments are a history; there is no use for one order over all players.
    newest = F.desc(F.coalesce(F.col("assigned_at").cast("string"), F.lit("")))
    return (joined.repartition("sams_player_id")
            .sortWithinPartitions(F.col("sams_player_id"), newest))


# --- guarded issue ---------------------------------------------------------------------------

#: What is still open: product, id, order, chunk, quantity and the stock left for it.
OPEN = ["_pid", "_rid", "_at", "_chunk", "_qty", "_left"]


def issue(requests: DataFrame, stock: DataFrame, *, order: str = "requested_at",
          request_id: str = "request_id", allow_negative: bool = False,
          few: int = 512, chunk: Column | None = None) -> DataFrame:
    """Accept or reject issue requests in order, so that no product goes below zero.

    A rejected request takes no stock, which makes acceptance sequential per product. Non-positive
    and larger-than-stock requests are rejected at once, and a product whose remaining requests fit
    together accepts them all. Products with at most ``few`` requests left are folded in order.
    The others go through rounds of prefix sums (``_halve``), each of which at least halves what a
    product has left, so there are at most as many as the stock has binary digits.

    ``chunk`` groups requests along ``order`` (default: its day); a chunk is what one task sorts.
    Ids must be unique integers. Quantities count in steps of 10**-15, a finer one as one step."""
    step = F.lit(1e-15).cast(EXACT)
    rows = requests.withColumns({
        "_pid": to_int("product_id"), "_asked": num_of(requests, "quantity", 0),
        "_qty": F.greatest(num_of(requests, "quantity", 0).try_cast(EXACT), step),
        "_rid": F.col(request_id).cast("long"),
        "_chunk": chunk if chunk is not None else F.to_date(order)})
    # A quantity too large for the type is null here and larger than any stock.
    rows = rows.withColumn("_qty", F.when(
        num_of(requests, "quantity", 0).try_cast(EXACT).isNotNull(), F.col("_qty")))
    base = stock.select(F.col("product_id").alias("_spid"),
                        F.col("on_hand").try_cast(EXACT).alias("_left"))
    rows = rows.join(base, F.col("_pid") == F.col("_spid"), "left").drop("_spid")
    rows = rows.withColumn("_left", F.coalesce("_left", F.lit(0).cast(EXACT)))
    valid = F.col("_asked") > 0
    if allow_negative:
        return _report(rows.withColumn("accepted", valid), requests)

    pending = cut(rows.where(valid & (F.col("_qty") <= F.col("_left"))).select(
        "_pid", "_rid", F.col(order).alias("_at"), "_chunk", "_qty", "_left"))
    yes = []
    while True:
        sizes = pending.groupBy(F.col("_pid").alias("_p")).agg(
            F.count(F.lit(1)).alias("_n"), F.try_sum("_qty").alias("_sum"))
        sized = pending.join(sizes, F.col("_pid") == F.col("_p")).drop("_p")
        fits = F.coalesce(F.col("_sum") <= F.col("_left"), F.lit(False))
        yes += [sized.where(fits).select("_rid"),
                _fold(sized.where(~fits & (F.col("_n") <= few)))]
        many = sized.where(~fits & (F.col("_n") > few)).select(*OPEN)
        if many.isEmpty():
            break
        accepted, pending = _halve(many)
        yes.append(accepted)
    ok = yes[0]
    for more in yes[1:]:
        ok = ok.unionAll(more)
    joined = rows.join(ok.select(F.col("_rid").alias("_ok")), rows["_rid"] == F.col("_ok"), "left")
    return _report(joined.withColumn("accepted", F.col("_ok").isNotNull()), requests)


def _fold(few: DataFrame) -> DataFrame:
    """``_rid`` of what is accepted in order, for products with few requests."""
    along = F.array_sort(F.collect_list(F.struct("_at", "_rid", "_qty")))
    products = few.groupBy("_pid").agg(along.alias("asked"), F.first("_left").alias("have"))

    def take(state: Column, ask: Column) -> Column:
        rest = (state["rest"] - ask["_qty"]).cast(EXACT)
        return F.when(ask["_qty"] <= state["rest"], F.struct(
            rest.alias("rest"), F.concat(state["ok"], F.array(ask["_rid"])).alias("ok"))
        ).otherwise(state)

    start = F.struct(F.col("have").alias("rest"), F.array().cast("array<bigint>").alias("ok"))
    return products.select(F.explode(F.aggregate("asked", start, take, lambda s: s["ok"]))
                           .alias("_rid"))


def _total_of(column: str, over: Column | None = None) -> Column:
    """Sum of the non-null values, 0 without any; totals beyond the type are its greatest number."""
    total, n = F.try_sum(column), F.count(column)
    if over is not None:
        total, n = total.over(over), n.over(over)
    most = F.lit("9" * 21).cast(EXACT)
    return F.when(n == 0, F.lit(0).cast(EXACT)).otherwise(
        F.coalesce(F.least(total, most), most).cast(EXACT))


def _halve(pending: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(accepted _rid, still open)`` after each product's stock has at least halved.

    Requests of at most half of what is left (small ones) are accepted as long as half is there,
    and the first larger one that fits leaves less than half. So up to the first request that
    takes the stock below half, large ones are rejected and small ones need only their prefix sum:
    by chunks first, then inside each chunk."""
    left, qty = F.col("_left"), F.col("_qty")
    rows = cut(pending.withColumn("_small", F.when(qty <= left - qty, qty)))
    sums = rows.groupBy("_pid", "_chunk").agg(_total_of("_small").alias("_sum"))
    earlier = W.partitionBy("_pid").orderBy("_chunk").rowsBetween(W.unboundedPreceding, -1)
    sums = sums.select(F.col("_pid").alias("_p"), F.col("_chunk").alias("_c"),
                       _total_of("_sum", earlier).alias("_base"))
    inside = (W.partitionBy("_pid", "_chunk").orderBy("_at", "_rid")
              .rowsBetween(W.unboundedPreceding, -1))
    own = _total_of("_small", inside)
    # What is there before each request, were no request before it the turning one.
    there = rows.join(sums, (F.col("_pid") == F.col("_p")) & F.col("_chunk").eqNullSafe(
        F.col("_c"))).withColumn("_there", ((left - F.col("_base")).try_cast(EXACT) - own)
                                 .try_cast(EXACT))
    after = F.col("_there") - qty
    turns = (qty <= F.col("_there")) & (after < left - after)
    place = F.struct("_chunk", "_at", "_rid")
    there = cut(there.select(*OPEN, "_small", place.alias("_place"), turns.alias("_turns"),
                             after.try_cast(EXACT).alias("_after")))
    turn = there.where("_turns").groupBy(F.col("_pid").alias("_p")).agg(
        F.min(F.struct("_place", "_after")).alias("_turn"))
    met = there.join(turn, F.col("_pid") == F.col("_p"), "left")
    at = F.col("_turn._place")
    open_ = F.coalesce(F.col("_place") > at, F.lit(False))
    taken = (F.col("_place") == at) | F.col("_small").isNotNull()
    still = met.where(open_).withColumn("_left", F.col("_turn._after"))
    return (met.where(~open_ & F.coalesce(taken, F.lit(False))).select("_rid"),
            cut(still.where(F.col("_qty") <= F.col("_left")).select(*OPEN)))


def _report(rows: DataFrame, requests: DataFrame) -> DataFrame:
    reason = (F.when(F.col("accepted"), F.lit(None))
              .when(F.col("_asked") <= 0, "quantity must be greater than zero")
              .otherwise("not enough in stock"))
    return rows.select(*requests.columns, "accepted", reason.cast("string").alias("reason"))
