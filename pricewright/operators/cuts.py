"""Exact places in an order of rows, found by counting ranges: no row is sorted, moved or numbered.

A cut says where the rows before it have a wanted total weight (their number, if every row weighs one).  Rows are
counted by ranges of the first order column, the range that holds the cut is divided further, and so on until few
rows are left; where one value alone holds more, the next order column decides.  Each step is one aggregate that
leaves a bounded number of rows, whatever the number of rows and however they are distributed.
"""

from __future__ import annotations

from collections import defaultdict
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

FETCHED = 64  # rows of a range that are looked at one by one
COUNTS = 1 << 18  # ranges counted in one step, about
MOST_BUCKETS = 4096
CASES = 64  # ranges that are told apart by an expression; more of them by a broadcast join


class Cut(NamedTuple):
    """The first row, in order, that no longer fits: `at` its order columns, None if all rows fit."""

    at: tuple[int, ...] | None
    before: int  # weight of all rows before it


class _Range(NamedTuple):
    group: int
    fixed: tuple[int, ...]  # values of the order columns before the current one
    low: int
    high: int


def _in_range(group: Column, order: list[str], r: _Range) -> Column:
    column = F.col(order[len(r.fixed)])
    found = (group == F.lit(r.group)) & (column >= F.lit(r.low)) & (column <= F.lit(r.high))
    for name, value in zip(order, r.fixed):
        found &= F.col(name) == F.lit(value)
    return found


def _ranged(rows: DataFrame, group: str | None, order: list[str], ranges: list[_Range], step: dict[_Range, int]) -> DataFrame:
    """Rows of the ranges, with the number of their range and of their bucket in it.  Ranges do not overlap."""
    if group is None or len(ranges) <= CASES:
        own = F.lit(0) if group is None else F.col(group)
        which, bucket = F.lit(None).cast("int"), F.lit(None).cast("long")
        for i, r in enumerate(ranges):
            inside = _in_range(own, order, r)
            which = F.when(inside, F.lit(i)).otherwise(which)
            bucket = F.when(inside, F.expr(f"(`{order[len(r.fixed)]}` - {r.low}L) div {step[r]}L")).otherwise(bucket)
        wanted = F.lit(False)
        for r in ranges:
            wanted |= _in_range(own, order, r)
        return rows.filter(wanted).select("*", which.alias("_range"), bucket.alias("_bucket"))
    table = [(r.group, i, len(r.fixed), *r.fixed, *[None] * (len(order) - 1 - len(r.fixed)), r.low, r.high, step[r]) for i, r in enumerate(ranges)]
    fixed = [f"_fixed{i}" for i in range(len(order) - 1)]
    schema = ", ".join(["_group long", "_range int", "_depth int", *[f"{n} long" for n in fixed], "_low long", "_high long", "_step long"])
    sides = F.broadcast(rows.sparkSession.createDataFrame(table, schema))  # one row a range
    current = F.col(order[0])
    for depth in range(1, len(order)):
        current = F.when(F.col("_depth") >= depth, F.col(order[depth])).otherwise(current)
    same = F.lit(True)
    for name, column in zip(fixed, order):
        same &= F.col(name).isNull() | (F.col(name) == F.col(column))
    joined = rows.join(sides, F.col(group) == F.col("_group")).filter(same & (current >= F.col("_low")) & (current <= F.col("_high")))
    return joined.withColumn("_bucket", F.floor((current - F.col("_low")) / F.col("_step")))


def cut_points(
    rows: DataFrame, order: list[str], wanted: list[tuple[int, int]], weight: str | None = None, group: str | None = None, fetched: int = FETCHED, counts: int = COUNTS
) -> list[Cut]:
    """For each (group, total) of `wanted` the cut before which rows of that group weigh `total` at most.

    `order`: whole-number columns without NULLs, unique per row together or else equal rows are interchangeable;
    `weight`: whole numbers, not negative.  Without `group` all rows are in group 0.  `rows` is read several times.
    """
    limits = rows.agg(*[f(c).alias(f"{f.__name__}{i}") for i, c in enumerate(order) for f in (F.min, F.max)]).first()
    if limits["min0"] is None:
        return [Cut(None, 0) for _ in wanted]
    heavy = F.lit(1).cast("long") if weight is None else F.col(weight)
    before = [0] * len(wanted)
    cuts: list[Cut | None] = [None] * len(wanted)
    places: dict[_Range, list[int]] = defaultdict(list)
    for i, (own, _) in enumerate(wanted):
        places[_Range(own, (), limits["min0"], limits["max0"])].append(i)

    few: dict[_Range, list[int]] = defaultdict(list)
    while places:
        ranges = list(places)
        buckets = max(2, min(MOST_BUCKETS, counts // len(ranges)))
        step = {r: (r.high - r.low) // buckets + 1 for r in ranges}
        found: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
        counted = _ranged(rows, group, order, ranges, step).groupBy("_range", "_bucket").agg(F.sum(heavy).alias("w"), F.count(F.lit(1)).alias("n"))
        for row in counted.collect():
            found[row["_range"]].append((row["_bucket"], row["w"], row["n"]))
        following: dict[_Range, list[int]] = defaultdict(list)
        for number, r in enumerate(ranges):
            sums = sorted(found[number])
            for i in places[r]:
                for bucket, w, n in sums:
                    if before[i] + w > wanted[i][1]:
                        low = r.low + bucket * step[r]
                        high = min(r.high, low + step[r] - 1)
                        if low == high and n > fetched and len(r.fixed) + 1 < len(order):
                            depth = len(r.fixed) + 1
                            following[_Range(r.group, (*r.fixed, low), limits[f"min{depth}"], limits[f"max{depth}"])].append(i)
                        elif n <= fetched or low == high:
                            few[r._replace(low=low, high=high)].append(i)
                        else:
                            following[r._replace(low=low, high=high)].append(i)
                        break
                    before[i] += w
                else:
                    cuts[i] = Cut(None, before[i])
        places = following
    if few:
        ranges = list(few)
        left: dict[int, list[tuple]] = defaultdict(list)
        rest = _ranged(rows, group, order, ranges, {r: 1 for r in ranges})
        for row in rest.groupBy("_range", *order).agg(F.sum(heavy).alias("w"), F.count(F.lit(1)).alias("n")).collect():
            left[row["_range"]].append((tuple(row[c] for c in order), row["w"]))
        for number, r in enumerate(ranges):
            for i in few[r]:
                for at, w in sorted(left[number]):
                    if before[i] + w > wanted[i][1]:
                        cuts[i] = Cut(at, before[i])
                        break
                    before[i] += w
    return cuts


def is_before(order: list[Column], at: list[Column]) -> Column:
    """True for rows whose order columns come before `at`."""
    found = F.lit(False)
    for own, other in reversed(list(zip(order, at))):
        found = (own < other) | ((own == other) & found)
    return found
