"""Exact medians of many columns at any row count."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

# Up to this many rows the built-in median (which keeps value counts in one task) is used.
BUILTIN_ROWS = 5_000_000
# A bracket this small is read as value counts.
BRACKET_ROWS = 100_000
ACCURACY = 10_000


def medians(
    df: DataFrame,
    columns: Sequence[str],
    *,
    approximate: bool = False,
    builtin_rows: int = BUILTIN_ROWS,
    bracket_rows: int = BRACKET_ROWS,
    accuracy: int = ACCURACY,
    rows: int | None = None,
) -> list[float | None]:
    """Median of the non-NULL values per column; None for a column without values.

    Large tables: a rank-bounded sketch brackets the middle, exact counts below and
    inside the bracket verify it, and the bracket is narrowed until its distinct values
    are few enough to read. The number of passes grows with log(n), not with skew.
    ``rows`` (a known row count) saves a counting pass on small tables.
    ``approximate`` returns the sketch value, whose rank error is at most n / accuracy.
    """
    names = [F.col(f"`{name}`") for name in columns]
    if approximate:
        row = df.agg(
            *[F.percentile_approx(c, 0.5, accuracy).alias(f"m{i}") for i, c in enumerate(names)]
        ).first()
        return [row[f"m{i}"] for i in range(len(names))]
    if rows is not None and rows <= builtin_rows:
        return _builtin(df, names)
    sizes = df.agg(*[F.count(c).alias(f"n{i}") for i, c in enumerate(names)]).first()
    counts = [sizes[f"n{i}"] for i in range(len(names))]
    if max(counts, default=0) <= builtin_rows:
        return _builtin(df, names)
    return _bracketed(df, names, counts, bracket_rows, accuracy)


def _builtin(df, names):
    row = df.agg(*[F.median(c).alias(f"m{i}") for i, c in enumerate(names)]).first()
    return [row[f"m{i}"] for i in range(len(names))]


def _bracketed(df, names, counts, bracket_rows, accuracy):
    # State per column: the middle lies strictly between low and high, where `inside`
    # values are; `below` values lie at or under low.
    results: dict[int, float | None] = {}
    state = {
        i: {"low": float("-inf"), "high": float("inf"), "below": 0, "inside": n}
        for i, n in enumerate(counts)
        if n
    }
    while True:
        for i in [i for i, s in state.items() if s["inside"] <= bracket_rows]:
            results[i] = _read_bracket(df, names[i], counts[i], state.pop(i))
        if not state:
            return [results.get(i) for i in range(len(names))]
        guess = df.agg(*[_guess(names[i], counts[i], s, accuracy).alias(f"g{i}") for i, s in state.items()]).first()
        seen = df.agg(
            *[a for i in state for a in _position_aggregates(i, names[i], *guess[f"g{i}"])]
        ).first()
        for i in list(state):
            low, high = guess[f"g{i}"]
            found = {key: seen[f"{key}{i}"] for key in POSITIONS}
            narrowed, value = _narrow(counts[i], state[i], low, high, found)
            if narrowed is None:
                results[i] = value
                del state[i]
            else:
                state[i] = narrowed


def _guess(column, count, bracket, accuracy):
    centre = ((count - 1) / 2 - bracket["below"]) / bracket["inside"]
    margin = 2.0 / accuracy
    within = F.when((column > bracket["low"]) & (column < bracket["high"]), column)
    ranks = F.array(F.lit(max(0.0, centre - margin)), F.lit(min(1.0, centre + margin)))
    return F.percentile_approx(within, ranks, F.lit(accuracy))


POSITIONS = ("under", "at_low", "between", "at_high", "before_low", "after_low", "before_high", "after_high")


def _position_aggregates(i, column, low, high):
    return [
        F.count(F.when(column < low, 1)).alias(f"under{i}"),
        F.count(F.when(column == low, 1)).alias(f"at_low{i}"),
        F.count(F.when((column > low) & (column < high), 1)).alias(f"between{i}"),
        F.count(F.when((column == high) & (column > low), 1)).alias(f"at_high{i}"),
        F.max(F.when(column < low, column)).alias(f"before_low{i}"),
        F.min(F.when(column > low, column)).alias(f"after_low{i}"),
        F.max(F.when(column < high, column)).alias(f"before_high{i}"),
        F.min(F.when(column > high, column)).alias(f"after_high{i}"),
    ]


def _narrow(count, bracket, low, high, found):
    """The next bracket, or the median once both middle ranks are pinned."""
    first, last = (count - 1) // 2, count // 2
    edges = [found["under"]]
    for key in ("at_low", "between", "at_high"):
        edges.append(edges[-1] + found[key])
    zone_first = sum(first >= e for e in edges)
    zone_last = sum(last >= e for e in edges)
    if zone_first == zone_last:
        if zone_first in (1, 3):
            return None, float(low if zone_first == 1 else high)
        if zone_first == 0:
            inside = found["under"] - bracket["below"]
            return {"low": bracket["low"], "high": low, "below": bracket["below"], "inside": inside}, None
        if zone_first == 2:
            return {"low": low, "high": high, "below": edges[1], "inside": found["between"]}, None
        inside = bracket["below"] + bracket["inside"] - edges[3]
        return {"low": high, "high": bracket["high"], "below": edges[3], "inside": inside}, None
    # The two middle values are neighbours across a zone border.
    left = {0: found["before_low"], 1: low, 2: found["before_high"], 3: high}[zone_first]
    right = {1: low, 2: found["after_low"], 3: high, 4: found["after_high"]}[zone_last]
    return None, (left + right) / 2.0


def _read_bracket(df, column, count, bracket):
    # At most bracket_rows distinct values reach the driver; ranks are 0-based.
    counted = (
        df.where((column > bracket["low"]) & (column < bracket["high"]))
        .groupBy(column.alias("v"))
        .agg(F.count(F.lit(1)).alias("n"))
        .collect()
    )
    first, last = (count - 1) // 2, count // 2
    seen, low, high = bracket["below"], None, None
    for row in sorted(counted, key=lambda r: r["v"]):
        seen += row["n"]
        if low is None and seen > first:
            low = row["v"]
        if seen > last:
            high = row["v"]
            break
    return (low + high) / 2.0
