"""Helpers of the bindings: table reads and SQL fragments with the operators' arithmetic."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sql_round(x: str, digits: int) -> str:
    """SQL for half-to-even rounding on the exact binary value; ``x`` should be a column name."""
    s = f"1e{digits}"
    p = f"(({x})*{s})"
    low = f"floor({p})"
    hi = f"(({x})*134217729.0e0-(({x})*134217729.0e0-({x})))"
    err = f"(({hi}*{s}-{p})+(({x})-{hi})*{s})"
    frac = f"({p}-{low})"
    odd = f"({low}-2e0*floor({low}/2e0))<>0"
    up = f"({frac}>0.5e0 or ({frac}=0.5e0 and ({err}>0 or ({err}=0 and {odd}))))"
    return f"(({low}+case when {up} then 1e0 else 0e0 end)/{s})"


def sql_sum(x: str, over: str = "") -> str:
    """SQL for a plain total of doubles: multiples of 2**-20, which add up exactly in any order,
    and the small rests."""
    v = f"cast(({x}) as double)"
    coarse = f"(round_even({v}*1048576e0, 0)/1048576e0)"
    return f"(sum({coarse}) {over} + sum({v} - {coarse}) {over})"


def sql_mean(x: str) -> str:
    return f"({sql_sum(x)}/nullif(count({x}),0))"


def day_text(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d')"
