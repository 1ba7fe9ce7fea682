"""Lenient parsing of numbers, dates and ids, and order-independent arithmetic.

Source cells are text more often than not. Every parser here returns NULL for what it cannot
read, so that one bad cell never fails a job under ANSI mode.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

NUMBER_TEXT = r"^\s*[-+]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][-+]?[0-9]+)?\s*$"
INTEGER_TEXT = r"^\s*[-+]?[0-9]+\s*$"
DATE_TEXT = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}"

#: Letters of an expression from which it is not written into a plan more than once.
LONG = 400

#: Step of the coarse part of a total; see ``exact_sum``.
GRID = float(2 ** 20)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def words(values: list[str]) -> Column:
    """A constant array of texts, folded by Spark before execution. Built from one literal: each
    literal of its own costs a call into the JVM whenever a plan is made."""
    return F.split(F.lit("|".join(values)), r"\|")


def lookup(table: dict, key: Column) -> Column:
    """The value of a constant text-to-text table, NULL for other keys."""
    pairs = "|".join(f"{k}~{v}" for k, v in table.items())
    return F.try_element_at(F.str_to_map(F.lit(pairs), F.lit(r"\|"), F.lit("~")), key)


def once(value: Column, use) -> Column:
    """``use(value)`` with the value computed a single time, for use within lambdas, where Spark
    does not share repeated subexpressions."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def finite(c: Column | str) -> Column:
    """A double with NaN and the infinities turned to NULL."""
    d = _col(c).cast("double")
    return F.when(F.abs(d) < F.lit(float("inf")), d)


def to_num(c: Column | str, default: float | None = None, strip: bool = False) -> Column:
    """Text to double, NULL (or ``default``) when it does not parse.

    ``strip`` drops stray characters around the digits before a second attempt."""
    s = _col(c).cast("string")
    out = F.when(s.rlike(NUMBER_TEXT), s.try_cast("double"))
    if strip:
        core = F.regexp_replace(s, r"[^0-9.\-]", "")
        out = F.coalesce(out, F.when(core.rlike(NUMBER_TEXT), core.try_cast("double")))
    out = finite(out)
    return out if default is None else F.coalesce(out, F.lit(float(default)))


def to_int(c: Column | str) -> Column:
    """Whole-number text to int; ``'3.0'`` does not parse."""
    s = _col(c).cast("string")
    return F.when(s.rlike(INTEGER_TEXT), s.try_cast("int"))


def to_day(c: Column | str) -> Column:
    """ISO text cut to ten characters, as a date; anything else is NULL."""
    return F.try_to_date(F.substring(_col(c).cast("string"), 1, 10), "yyyy-MM-dd")


def num_of(df: DataFrame, name: str, default: float | None = None) -> Column:
    """``to_num`` that leaves already numeric columns to a plain cast."""
    if isinstance(df.schema[name].dataType, T.NumericType):
        out = finite(name)
        return out if default is None else F.coalesce(out, F.lit(float(default)))
    return to_num(name, default)


def int_of(df: DataFrame, name: str) -> Column:
    """``to_int`` that leaves whole-number columns to a plain cast."""
    if isinstance(df.schema[name].dataType, T.IntegralType):
        return F.col(name).try_cast("int")
    return to_int(name)


def day_of(df: DataFrame, name: str) -> Column:
    """``to_day`` that leaves date and timestamp columns to a plain cast."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.DateType):
        return F.col(name)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.to_date(name)
    return to_day(name)


def blank_to_null(c: Column | str) -> Column:
    """Device ids: the empty text, ``0`` and ``None`` all mean "no id"."""
    s = _col(c).cast("string")
    return F.when(~s.isin("", "0", "None"), s)


def present(c: Column | str) -> Column:
    """NULL and the empty text become NULL."""
    s = _col(c)
    return F.when(s.cast("string") != "", s)


def exact_sum(c: Column | str, over: Column | None = None) -> Column:
    """Total of a double column, a plain sum whose digits do not depend on the order of rows.

    Each value is split into the nearest multiple of 2**-20 and the rest, both without loss. The
    multiples add up exactly in any order as long as totals stay below 2**33, the rests are so
    small that their rounding is far below the last digit of the total. Beyond that it is a usual
    floating sum: nothing is cut, capped or fails. ``over`` turns both sums into windows."""
    x = _col(c).cast("double")
    coarse = F.when(F.abs(x) < F.lit(1e15), F.rint(x * F.lit(GRID)) / F.lit(GRID)).otherwise(x)
    parts = [F.sum(coarse), F.sum(x - coarse)]
    return parts[0] + parts[1] if over is None else parts[0].over(over) + parts[1].over(over)


def exact_mean(c: Column | str) -> Column:
    """Order-independent mean over the non-null values; NULL when there are none."""
    col = _col(c)
    return exact_sum(col) / F.nullif(F.count(col), F.lit(0))


def round_py(c: Column | str, digits: int) -> Column:
    """Round half to even on the exact binary value, as IEEE-correct libraries do.

    ``x * 10**digits`` is split into its rounded product and the exact product error
    (error-free transformation), so that ``2.675`` (stored as 2.67499...) rounds to 2.67 and
    ``0.125`` to 0.12. Values of 2**52 and above carry no fraction and are kept."""
    if isinstance(c, Column) and len(str(c)) > LONG:
        # The value is used a dozen times: a long expression is computed once, not repeated.
        return once(c.cast("double"), lambda x: _round_py(x, digits))
    return _round_py(_col(c).cast("double"), digits)


def _round_py(x: Column, digits: int) -> Column:
    scale = F.lit(float(10 ** digits))
    p = x * scale
    near = F.rint(p)
    hi = x * F.lit(134217729.0) - (x * F.lit(134217729.0) - x)
    err = (hi * scale - p) + (x - hi) * scale
    tie = F.abs(p - near) == 0.5
    whole = (F.when(tie & (err > 0.0), F.ceil(p).cast("double"))
             .when(tie & (err < 0.0), F.floor(p).cast("double"))
             .otherwise(near))
    # Adding zero turns a negative zero into zero.
    return F.when(F.abs(p) < F.lit(4503599627370496.0), (whole + F.lit(0.0)) / scale).otherwise(x)


def whole_years(born: Column, at: Column) -> Column:
    """Completed calendar years between two dates."""
    before = (F.month(at) * 100 + F.dayofmonth(at)) < (F.month(born) * 100 + F.dayofmonth(born))
    return F.year(at) - F.year(born) - F.when(before, 1).otherwise(0)


def age_at(born: Column, at: Column) -> Column:
    """Whole-year age, NULL outside 0..100 (usually swapped or two-digit dates)."""
    years = whole_years(born, at)
    return F.when(years.between(0, 100), years)


def decimal_age(born: Column, at: Column) -> Column:
    """Age in years of 365.25 days."""
    return F.datediff(at, born) / F.lit(365.25)


def iso(c: Column | str) -> Column:
    """A date as ISO text."""
    return F.date_format(_col(c), "yyyy-MM-dd")
