"""Recursive averages y[t] = q y[t-1] + w x[t] from window functions.

A series is cut into blocks. Inside a block the recurrence has a closed form, a scaled running sum; what
earlier blocks carry over is a short sum of their last values, as powers of q soon vanish.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

BLOCK = 64


@dataclass(frozen=True)
class Recursion:
    """A recursive average of the column `source`, of which the one called `name` is made.

    It begins at row `start` of a segment (0 is the first) with the mean of the `seed` values up to that row, and is shown from row `shown`.
    """

    name: str
    source: str
    decay: float
    start: int = 0
    seed: int = 1
    shown: int = 0


def ema(name: str, source: str, span: int, start: int = 0) -> Recursion:
    """Exponential average with weight 2 / (span + 1), seeded by the first value and shown from the span-th one."""
    return Recursion(name, source, 1 - 2 / (span + 1), start, 1, start + span - 1)


def wilder(name: str, source: str, period: int, first: int = 0) -> Recursion:
    """Average with weight 1 / period, seeded by the mean of the first `period` values; `first` is the row of the first one."""
    return Recursion(name, source, 1 - 1 / period, first + period - 1, period, first + period - 1)


def terms(decay: float) -> int:
    """Earlier blocks of which a value has any trace."""
    return math.ceil(math.log(1e-17) / (BLOCK * math.log(decay))) if decay else 0


def recurse(rows: DataFrame, keys: list[str], order: str, position: str, specs: list[Recursion]) -> DataFrame:
    """Add a column per spec. position: 0, 1, ... in each segment named by keys, ordered by `order`."""
    segment = Window.partitionBy(*keys).orderBy(order)
    block = Window.partitionBy(*keys, "_block").orderBy(order)
    so_far = block.rowsBetween(Window.unboundedPreceding, 0)
    pos = F.col(position)
    out = rows.withColumns({"_block": F.floor(pos / BLOCK), "_place": (pos % BLOCK).cast("double")})
    weighed = {}
    for s in specs:
        x = F.col(s.source).cast("double")
        first = x if s.seed == 1 else F.avg(x).over(segment.rowsBetween(-(s.seed - 1), 0))
        weighed[f"_x_{s.name}"] = F.when(pos < s.start, 0.0).when(pos == s.start, first).otherwise((1 - s.decay) * x)
    out = out.withColumns(weighed)
    place = F.col("_place")
    # with decay 0 (a span or period of 1) the average is the value itself
    made = {s.name: F.when(pos >= s.shown, F.col(f"_x_{s.name}")) for s in specs if not s.decay}
    specs = [s for s in specs if s.decay]
    out = out.withColumns({f"_s_{s.name}": F.pow(F.lit(s.decay), place) * F.sum(F.col(f"_x_{s.name}") * F.pow(F.lit(s.decay), -place)).over(so_far) for s in specs})
    carried = {}
    for s in specs:
        carry = F.lit(0.0)
        for m in range(terms(s.decay)):
            carry = carry + F.coalesce(F.lag(f"_s_{s.name}", 1 + BLOCK * m).over(segment), F.lit(0.0)) * s.decay ** (BLOCK * m)
        carried[f"_c_{s.name}"] = F.when(place == 0, carry)
    out = out.withColumns(carried)
    for s in specs:
        carry = F.first(f"_c_{s.name}").over(so_far)
        made[s.name] = F.when(pos >= s.shown, F.col(f"_s_{s.name}") + carry * F.pow(F.lit(s.decay), place + 1))
    return out.withColumns(made).drop("_block", "_place", *[f"{p}{name}" for name in made for p in ("_x_", "_s_", "_c_")])
