"""Exact quantiles (linear interpolation, as pandas / ``quantile_cont``) by rank brackets.

``percentile()`` merges a value -> count map for each group in a single task; for a
global quantile over a continuous column that map holds every distinct value.  Here

1. one pass makes a mergeable sketch of every column (``percentile_approx``) beside
   whatever else is asked of it; its cuts a little below and above a quantile's rank
   bracket the value;
2. a second pass counts the rows of the zones between the brackets, and the values
   inside them one by one, with a map-side combine: one row per zone and value;
3. the driver adds the counts up.  They are exact, so they tell whether a bracket
   holds its ranks; if not (a sketch promises its error, it is not trusted), that side
   opens to the column's end.

A bracket with more distinct values than MOST_VALUES in all is narrowed first by a
sketch of its own values, in as many passes as needed: each divides it by some
thousands.  What reaches the driver has that bound, whatever the input.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

#: Ranks of a sketch are off by 1 / ACCURACY of the rows at most.
ACCURACY = 10_000
#: Distinct values that the brackets of one pass may hold together.
MOST_VALUES = 100_000


def long_values(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, value) rows for the non-NULL values of ``columns``."""
    pairs = [F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("value")) for c in columns]
    return df.select(F.explode(F.array(*pairs)).alias("_kv")).select("_kv.column_name", "_kv.value").where("value IS NOT NULL")


@dataclass
class _Target:
    """One quantile of one column: the places of its neighbours and the bracket known so far."""

    column: int
    lo: int
    hi: int
    low: float
    high: float


def _number(value: Column) -> Column:
    """The value as double; NaN, which sorts last, is counted apart."""
    value = value.cast("double")
    return F.when(~F.isnan(value), value)


def _shares(position: float, rows: int, accuracy: int) -> list[float]:
    """Shares of the rows safely below and above a place."""
    slack = 2 / accuracy
    at = (position + 0.5) / max(rows, 1)
    return [min(1.0, max(0.0, at - slack)), min(1.0, max(0.0, at + slack))]


def sketches(columns: list[Column], probs: list[float], accuracy: int = ACCURACY) -> list[Column]:
    """Aggregates of the first pass, to be put beside others and handed to ``quantiles``."""
    out = []
    for i, c in enumerate(columns):
        v = _number(c)
        cuts = [x for p in probs for x in (max(0.0, p - 2 / accuracy), min(1.0, p + 2 / accuracy))]
        out += [
            F.count(v).alias(f"_q{i}_n"), F.count_if(F.isnan(c.cast("double"))).alias(f"_q{i}_nan"),
            F.min(v).alias(f"_q{i}_min"), F.max(v).alias(f"_q{i}_max"), F.percentile_approx(v, cuts, accuracy).alias(f"_q{i}_cuts"),
        ]
    return out


def quantiles(
    df: DataFrame, columns: list[Column], probs: list[float], first: Row, accuracy: int = ACCURACY, most_values: int = MOST_VALUES
) -> list[list[float | None]]:
    """The quantiles of every column; ``first`` holds the ``sketches`` of the same rows."""
    targets: list[_Target] = []
    for i in range(len(columns)):
        n, total = first[f"_q{i}_n"], first[f"_q{i}_n"] + first[f"_q{i}_nan"]
        for k, p in enumerate(probs):
            place = p * (total - 1)
            if n and math.floor(place) < n:
                low, high = first[f"_q{i}_cuts"][2 * k : 2 * k + 2]
                # The lowest and highest place need no cut.
                low = first[f"_q{i}_min"] if math.floor(place) == 0 else low
                high = first[f"_q{i}_max"] if min(math.ceil(place), n - 1) == n - 1 else high
                targets.append(_Target(i, math.floor(place), min(math.ceil(place), n - 1), low, high))
    found: dict[tuple[int, int], float] = {}
    open_targets = targets
    while open_targets:
        counted = _count_zones(df, columns, open_targets, most_values)
        while counted is None:  # a bracket that cannot be narrowed holds a few values
            narrower = _narrow(df, columns, open_targets, accuracy)
            counted = _count_zones(df, columns, open_targets, most_values if narrower else None)
        missed = []
        for t in open_targets:
            if not _look_up(t, counted[t.column], first, found):
                missed.append(t)
        open_targets = missed
    out = []
    for i in range(len(columns)):
        n, total = first[f"_q{i}_n"], first[f"_q{i}_n"] + first[f"_q{i}_nan"]
        out.append([_interpolated(found, i, p * (total - 1), n) if total else None for p in probs])
    return out


def _interpolated(found: dict, column: int, place: float, n: int) -> float:
    """NaN takes the places from ``n`` on."""
    lo = found[column, math.floor(place)] if math.floor(place) < n else math.nan
    part = place - math.floor(place)
    if not part:
        return lo
    hi = found[column, math.ceil(place)] if math.ceil(place) < n else math.nan
    return lo + part * (hi - lo)


def _intervals(targets: list[_Target], column: int) -> list[tuple[float, float]]:
    """The column's brackets, overlapping ones joined."""
    out: list[list[float]] = []
    for low, high in sorted((t.low, t.high) for t in targets if t.column == column):
        if out and low <= out[-1][1]:
            out[-1][1] = max(out[-1][1], high)
        else:
            out.append([low, high])
    return [tuple(x) for x in out]


def _count_zones(df: DataFrame, columns: list[Column], targets: list[_Target], most_values: int | None) -> dict | None:
    """Per column its (zone, value, rows) in order, value None outside the brackets; None if they are too many."""
    cells, least = [], 0
    for i in sorted({t.column for t in targets}):
        v, zone = _number(columns[i]), F.lit(0)
        intervals = _intervals(targets, i)
        least += 3 * len(intervals) + 1
        for low, high in intervals:
            zone = zone + (v >= F.lit(low)).cast("int") + (v > F.lit(high)).cast("int")
        cells.append(F.struct(F.lit(i).alias("c"), zone.alias("zone"), F.when(zone % 2 == 1, v).alias("value")))
    rows = df.select(F.explode(F.array(*cells)).alias("_x")).select("_x.*").where("zone IS NOT NULL")
    grouped = rows.groupBy("c", "zone", "value").agg(F.count(F.lit(1)).alias("rows"))
    most = None if most_values is None else max(most_values, least)
    counts = (grouped if most is None else grouped.limit(most + 1)).collect()
    if most is not None and len(counts) > most:
        return None
    out: dict[int, list] = {i: [] for i in range(len(columns))}
    for r in counts:
        out[r["c"]].append((r["zone"], r["value"], r["rows"]))
    return {i: sorted(x, key=lambda y: (y[0], y[1] if y[1] is not None else 0.0)) for i, x in out.items()}


def _look_up(t: _Target, zones: list, first: Row, found: dict) -> bool:
    """Puts the values at the target's places into ``found``; opens the bracket's side that misses one."""
    before, below, above = 0, False, False
    for _, value, rows in zones:
        for place in (t.lo, t.hi):
            if before <= place < before + rows and (t.column, place) not in found:
                if value is not None:
                    found[t.column, place] = value
        before += rows
    if (t.column, t.lo) in found and (t.column, t.hi) in found:
        return True
    start = sum(rows for zone, value, rows in zones if value is None and zone == 0)
    below, above = t.lo < start or (t.column, t.lo) not in found, (t.column, t.hi) not in found
    if below:
        t.low = first[f"_q{t.column}_min"]
    if above:
        t.high = first[f"_q{t.column}_max"]
    return False


def _narrow(df: DataFrame, columns: list[Column], targets: list[_Target], accuracy: int) -> bool:
    """Smaller brackets from exact counts below each and a sketch of the values inside; False if none is."""
    asked, narrower = [], False
    for k, t in enumerate(targets):
        v = _number(columns[t.column])
        inside = (v >= F.lit(t.low)) & (v <= F.lit(t.high))
        shares = [i / 256 for i in range(257)]
        asked += [
            F.count_if(v < F.lit(t.low)).alias(f"below{k}"), F.count_if(inside).alias(f"inside{k}"),
            F.percentile_approx(F.when(inside, v), shares, max(accuracy, 2048)).alias(f"cuts{k}"),
        ]
    got = df.agg(*asked).first()
    for k, t in enumerate(targets):
        n, cuts = got[f"inside{k}"], got[f"cuts{k}"]
        if not n or not got[f"below{k}"] <= t.lo or t.hi >= got[f"below{k}"] + n:
            continue
        slack = 2 / max(accuracy, 2048)
        low = [c for i, c in enumerate(cuts) if i / 256 <= (t.lo - got[f"below{k}"]) / n - slack]
        high = [c for i, c in enumerate(cuts) if i / 256 >= (t.hi - got[f"below{k}"] + 1) / n + slack]
        to = max([t.low, *low[-1:]]), min([t.high, *high[:1]])
        narrower |= to != (t.low, t.high)
        t.low, t.high = to
    return narrower


def exact_quantiles(values: DataFrame, probs: list[float], accuracy: int = ACCURACY, most_values: int = MOST_VALUES) -> DataFrame:
    """Quantiles of long-form ``(column_name, value)`` rows.

    Returns one row per column with ``q_<k>`` columns (k = index in ``probs``)
    and ``n`` (non-NULL count).  NaN values are treated as the largest values,
    as Spark orders them.
    """
    names = [r[0] for r in values.select("column_name").distinct().collect()]  # profiled columns
    columns = [F.when(F.col("column_name") == n, F.col("value")) for n in names]
    schema = "column_name string, n bigint, " + ", ".join(f"q_{k} double" for k in range(len(probs)))
    rows = []
    if names:
        first = values.agg(*sketches(columns, probs, accuracy)).first()
        found = quantiles(values, columns, probs, first, accuracy, most_values)
        rows = [(n, first[f"_q{i}_n"] + first[f"_q{i}_nan"], *q) for i, (n, q) in enumerate(zip(names, found))]
    return values.sparkSession.createDataFrame(rows, schema)
