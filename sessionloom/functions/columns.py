"""Column functions shared by the operators. Null means missing everywhere; NaN is turned into null on entry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

INFINITY = float("inf")


def finite(c: Column) -> Column:
    """c, or null where it is NaN or infinite."""
    return F.when(~F.isnan(c) & (F.abs(c) != INFINITY), c)


def is_finite(c: Column) -> Column:
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) != INFINITY)


def divide(a: Column, b: Column) -> Column:
    """a / b, null where b is 0."""
    return F.when(b != 0, a / b)


def ratio(a: Column, b: Column) -> Column:
    """a / b where b is positive and finite, else null."""
    return F.when((b > 0) & (b != INFINITY), a / b)


def over_full(aggregate, c: Column, window: WindowSpec, first: int, last: int) -> Column:
    """aggregate(c) over the rows first..last around the current one, null unless all of them have a value."""
    frame = window.rowsBetween(first, last)
    return F.when(F.count(c).over(frame) == last - first + 1, aggregate(c).over(frame))


def spread(rows: DataFrame, *keys: str) -> DataFrame:
    """rows by keys in as many partitions as a shuffle has.

    Windows over the keys need no other exchange. The adaptive planner sizes tasks by bytes and would merge these, but sliding windows cost far more
    than their bytes.
    """
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def exchange_date(ts: Column, zone: str = "Asia/Kolkata") -> Column:
    """Date of an instant (UTC) at the exchange."""
    return F.to_date(F.from_utc_timestamp(ts, zone))


def to_number(c: Column) -> Column:
    """c as double; what is no finite number is null."""
    return finite(c.cast("string").try_cast("double"))


def bad_number(c: Column) -> Column:
    """True where a value is present and is no number."""
    return c.isNotNull() & c.cast("string").try_cast("double").isNull()


def order_key(**digits: int) -> Column:
    """One decimal that sorts like the columns named, whole numbers of so many digits at most (more are an error; 38 in all). Only the first may be negative.

    It has a fixed width, so that min_by and max_by over it are hash aggregates, which a struct's aren't. Neighbours are packed as longs first, as
    arithmetic on decimals is slow.
    """
    if sum(digits.values()) > 38:
        raise ValueError("an order key holds 38 digits")
    longs: list[tuple[Column, int]] = []
    for name, n in digits.items():
        c = F.col(name).cast("long")
        low = 0 if longs else -(10**n) + 1
        if n < 19:  # 19 digits hold every long
            c = F.when((c < low) | (c >= 10**n), F.raise_error(F.lit(f"{name} is out of its {n} digits"))).otherwise(c)
        elif longs:
            c = F.when(c < 0, F.raise_error(F.lit(f"{name} is negative"))).otherwise(c)
        if longs and longs[-1][1] + n <= 18:
            before, width = longs.pop()
            longs.append((before * F.lit(10**n).cast("long") + c, width + n))
        else:
            longs.append((c, n))
    out, width = None, 0
    for c, n in reversed(longs):
        part = c.cast(f"decimal({n},0)")
        out = part if out is None else part * F.lit(str(10**width)).cast(f"decimal({width + 1},0)") + out
        width += n
    return out


def one_hot(c: Column, values: list[str], prefix: str) -> list[Column]:
    return [F.when(c == v, 1.0).otherwise(0.0).alias(f"{prefix}_{v}") for v in values]


def as_json(*columns: str) -> Column:
    """The row as a JSON object that keeps nulls; NaN counts as null."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"})
