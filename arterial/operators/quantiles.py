"""Exact order statistics and quantiles without gathering a column in one task."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Distinct values one task may hold while ranking them.
MAX_VALUES = 1_000_000
_ACCURACY = 10_000
_WIDENINGS = 3


@dataclass
class _Bracket:
    """Where the value of a rank lies: ``below`` values are smaller than ``low``, ``inside`` are in [low, high]."""

    column: str
    rank: int
    below: int
    inside: int
    low: float | None = None
    high: float | None = None

    def holds(self) -> Column:
        c = F.col(self.column)
        test = c.isNotNull()
        if self.low is not None:
            test = test & (c >= F.lit(self.low))
        return test if self.high is None else test & (c <= F.lit(self.high))


def _narrowed(numbers: DataFrame, brackets: Sequence[_Bracket], margin: float) -> tuple[list[_Bracket], list[_Bracket]]:
    """(brackets made about ``margin`` wide, those the sketch missed): two scans, however many brackets there are."""
    shares = [((b.rank - b.below) / b.inside - margin, (b.rank - b.below + 1) / b.inside + margin) for b in brackets]
    limits = []
    for i, (b, (low, high)) in enumerate(zip(brackets, shares)):
        inside = F.when(b.holds(), F.col(b.column))
        at = F.array(F.lit(max(low, 0.0)), F.lit(min(high, 1.0)))
        limits.append(F.percentile_approx(inside, at, _ACCURACY).alias(f"p{i}"))
    found = numbers.agg(*limits).first()
    tried = [
        _Bracket(b.column, b.rank, b.below, b.inside, b.low if low <= 0 else found[i][0], b.high if high >= 1 else found[i][1])
        for i, (b, (low, high)) in enumerate(zip(brackets, shares))
    ]
    counts = []
    for i, (b, t) in enumerate(zip(brackets, tried)):
        skipped = F.lit(False) if t.low is None else b.holds() & (F.col(b.column) < F.lit(t.low))
        counts += [F.count_if(skipped).alias(f"s{i}"), F.count_if(t.holds()).alias(f"n{i}")]
    row = numbers.agg(*counts).first()
    good, missed = [], []
    for i, (b, t) in enumerate(zip(brackets, tried)):
        t.below, t.inside = b.below + row[f"s{i}"], row[f"n{i}"]
        (good if t.below <= b.rank < t.below + t.inside else missed).append(t if t.below <= b.rank < t.below + t.inside else b)
    return good, missed


def _ranked(numbers: DataFrame, brackets: Sequence[_Bracket]) -> dict[tuple[str, int], float]:
    """The values of all brackets in one grouped scan; a bracket is one task's share of the last step."""
    same: dict[tuple, list[_Bracket]] = {}
    for b in brackets:
        same.setdefault((b.column, b.low, b.high), []).append(b)
    options = [
        F.when(group[0].holds(), F.struct(F.lit(i).alias("i"), F.col(group[0].column).alias("v"))) for i, group in enumerate(same.values())
    ]
    stacked = numbers.select(F.explode(F.array_compact(F.array(*options))).alias("x")).select("x.i", "x.v")
    counts = stacked.groupBy("i", "v").agg(F.count("*").alias("n"))
    upto = F.sum("n").over(W.partitionBy("i").orderBy("v"))
    wanted = F.lit(False)
    for i, group in enumerate(same.values()):
        for rank in {b.rank - b.below for b in group}:
            wanted = wanted | ((F.col("i") == i) & (F.col("upto") > rank) & (F.col("upto") - F.col("n") <= rank))
    rows = counts.withColumn("upto", upto).where(wanted).collect()
    groups = list(same.values())
    return {
        (b.column, b.rank): r["v"] for r in rows for b in groups[r["i"]] if r["upto"] - r["n"] <= b.rank - b.below < r["upto"]
    }


def order_statistics_of(
    df: DataFrame, ranks: dict[str, Sequence[int]], max_values: int = MAX_VALUES
) -> dict[tuple[str, int], float]:
    """The values at 0-based ranks of the non-null values of numeric columns in ascending order, by (column, rank).

    Approximate percentiles bracket every rank and exact counts confirm the brackets, all columns and ranks together;
    a pass makes a bracket about a thousandth as wide, and passes repeat until each holds at most about ``max_values``
    distinct values. So the number of scans depends on the number of rows only, and by its logarithm.
    """
    columns = [c for c, r in ranks.items() if r]
    if not columns:
        return {}
    numbers = df.select(*columns)
    sizes = numbers.agg(*[x for c in columns for x in (F.count(c), F.approx_count_distinct(c, 0.02))]).first()
    total = {c: (sizes[2 * i], sizes[2 * i + 1]) for i, c in enumerate(columns)}
    brackets = [_Bracket(c, r, 0, total[c][0]) for c in columns for r in sorted(set(ranks[c]))]
    ready = [b for b in brackets if total[b.column][1] <= max_values]
    open_ = [b for b in brackets if total[b.column][1] > max_values]
    while open_:
        margin, left, done = 2.0 / _ACCURACY, open_, []
        for _ in range(_WIDENINGS):
            good, left = _narrowed(numbers, left, margin)
            done += good
            if not left:
                break
            margin *= 8
        ready += left  # the sketch keeps missing them: rank the last bracket that held
        distinct = numbers.agg(*[F.approx_count_distinct(F.when(b.holds(), F.col(b.column)), 0.02) for b in done]).first() if done else ()
        before = {(b.column, b.rank): b.inside for b in open_}
        # a bracket that does not shrink any more is one value many times over, or as good as that
        small = [n <= max_values or b.inside >= before[b.column, b.rank] for b, n in zip(done, distinct)]
        ready += [b for b, s in zip(done, small) if s]
        open_ = [b for b, s in zip(done, small) if not s]
    return _ranked(numbers, ready)


def order_statistics(df: DataFrame, column: str, ranks: Sequence[int], max_values: int = MAX_VALUES) -> dict[int, object]:
    """``order_statistics_of`` for one column, by rank."""
    return {rank: value for (_, rank), value in order_statistics_of(df, {column: ranks}, max_values).items()}


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    max_values: int = MAX_VALUES,
) -> dict[str, list[float | None]]:
    """Linearly interpolated quantiles of the non-null values of numeric columns.

    Columns with up to ``max_values`` values take Spark's ``percentile``, all in one scan; the others share the passes of
    ``order_statistics_of``. Both are exact.
    """
    columns = list(columns)
    if not columns:
        return {}
    numbers = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    counts = numbers.agg(*[F.count(c).alias(c) for c in columns]).first().asDict()
    small = [c for c in columns if counts[c] <= max_values]
    out: dict[str, list[float | None]] = {}
    if small:
        probs = F.array(*[F.lit(float(p)) for p in probabilities])
        row = numbers.agg(*[F.percentile(c, probs).alias(c) for c in small]).first()
        out.update({c: list(row[c]) if row[c] is not None else [None] * len(probabilities) for c in small})
    places = {c: [(counts[c] - 1) * p for p in probabilities] for c in columns if c not in out}
    found = order_statistics_of(numbers, {c: [f(x) for x in at for f in (math.floor, math.ceil)] for c, at in places.items()}, max_values)
    for c, at in places.items():
        ends = [(found[c, math.floor(x)], found[c, math.ceil(x)], x - math.floor(x)) for x in at]
        out[c] = [low + (high - low) * share for low, high, share in ends]
    return {c: out[c] for c in columns}
