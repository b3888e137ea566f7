"""Exact quantiles by repeated rank selection over quantile splitters.

A quantile is the value at one rank or two. Each round draws approximate quantiles of the values that
are still in question as splitters, counts exactly how many values lie at and between them, and keeps what
lies between the two splitters that enclose the rank. A frequent value is a splitter and is counted by itself, so
every round leaves a small fraction, however the values are distributed; few rounds do for any
size. Only counts reach the driver, and at the end at most ``few`` values per rank.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Gap = tuple[str, float | None, float | None]  # a column, and the values between which the rank lies

SPLITTERS = 128


def _in_gaps(values: DataFrame, gaps: list[Gap]) -> DataFrame:
    """(gap, x) of the values (column, x) that lie in one of the gaps, which don't overlap."""
    gap = F.lit(None).cast("int")
    for i, (column, low, high) in enumerate(gaps):
        inside = F.col("column") == column
        inside = inside & (F.col("x") > low) if low is not None else inside
        inside = inside & (F.col("x") < high) if high is not None else inside
        gap = F.when(inside, F.lit(i)).otherwise(gap)
    return values.select(gap.alias("gap"), "x").where("gap IS NOT NULL")


def _counted(inside: DataFrame, splitters: list[list[float]]) -> dict[int, dict[int, int]]:
    """How many values of each gap are at (odd) and between (even) its splitters."""
    drawn = F.array(*[F.array(*[F.lit(s) for s in own]).cast("array<double>") for own in splitters])
    own = F.element_at(drawn, F.col("gap") + 1)
    place = 2 * F.size(F.filter(own, lambda s: s < F.col("x"))) + F.array_contains(own, F.col("x")).cast("int")
    counts: dict[int, dict[int, int]] = {}
    for r in inside.select("gap", place.alias("place")).groupBy("gap", "place").agg(F.count("*").alias("n")).collect():
        counts.setdefault(r["gap"], {})[r["place"]] = r["n"]
    return counts


def quantiles(df: DataFrame, columns: list[str], probabilities: list[float],
              few: int = 4096) -> dict[str, list[float | None]]:
    """The exact quantiles of each numeric column, linear between neighbours; nulls and NaN are passed over.

    A column without values has None. ``few`` bounds the values of one gap that are sorted at once.
    """
    values = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("double").alias("x"))
                                          for c in columns]))).where("x IS NOT NULL AND NOT isnan(x)")
    total = {r["column"]: r["n"] for r in values.groupBy("column").agg(F.count("*").alias("n")).collect()}
    # (column, rank) -> its gap, the number of values below the gap, the number in it
    asked: dict[tuple[str, int], tuple[Gap, int, int]] = {}
    found: dict[tuple[str, int], float] = {}
    for c, n in total.items():
        for p in probabilities:
            for rank in {math.floor(p * (n - 1)), math.ceil(p * (n - 1))}:
                asked[c, rank] = ((c, None, None), 0, n)
    while large := sorted({g for g, _, n in asked.values() if n > few}, key=str):
        inside = _in_gaps(values, large)
        drawn = inside.groupBy("gap").agg(F.percentile_approx(
            "x", [i / SPLITTERS for i in range(SPLITTERS + 1)], 8 * SPLITTERS).alias("s")).collect()
        splitters: list[list[float]] = [[] for _ in large]
        for r in drawn:
            splitters[r["gap"]] = sorted(set(r["s"]))
        counts = _counted(inside, splitters)
        for key, (gap, below, n) in list(asked.items()):
            if n <= few:
                continue
            own = splitters[large.index(gap)]
            for place, size in sorted(counts[large.index(gap)].items()):
                if key[1] >= below + size:
                    below += size
                    continue
                if place % 2:
                    found[key] = own[place // 2]
                    del asked[key]
                else:  # the lowest and the highest value are splitters, so there is one on either side
                    asked[key] = ((gap[0], own[place // 2 - 1], own[place // 2]), below, size)
                break
    small = sorted({g for g, _, _ in asked.values()}, key=str)
    if small:
        lists = _in_gaps(values, small).groupBy("gap").agg(F.array_sort(F.collect_list("x")).alias("xs")).collect()
        sorted_values = {small[r["gap"]]: r["xs"] for r in lists}
        found |= {key: sorted_values[gap][key[1] - below] for key, (gap, below, _) in asked.items()}

    def at(c: str, p: float) -> float | None:
        if c not in total:
            return None
        rank = p * (total[c] - 1)
        low, high = found[c, math.floor(rank)], found[c, math.ceil(rank)]
        return low if low == high else low + (high - low) * (rank - math.floor(rank))

    return {c: [at(c, p) for p in probabilities] for c in columns}
