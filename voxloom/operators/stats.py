"""Duration statistics and an equal-width histogram."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BINS = 20


#: Values that one task may sort for the median, and into how many parts a wider range is cut.
_SORTED, _PARTS = 100_000, 1024


def _at_rank(df: DataFrame, rank: int) -> float:
    """The value of column ``v`` at a rank from 0, exactly: the range around it is cut until few values are left."""
    lo, hi = df.agg(F.min("v"), F.max("v")).first()
    n = None
    while lo < hi and (n is None or n > _SORTED):
        width = (hi - lo) / _PARTS
        if not lo < lo + width < hi:
            break  # neighbouring numbers
        part = F.least(F.floor((F.col("v") - F.lit(lo)) / F.lit(width)), F.lit(_PARTS - 1))
        inside = df.where(F.col("v").between(lo, hi)).groupBy(part.alias("p")).agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
        for r in inside.orderBy("p").collect():  # at most a row a part
            if rank < r["n"]:
                break
            rank -= r["n"]
        lo, hi, n = r["lo"], r["hi"], r["n"]
    if lo == hi:
        return lo
    values = df.where(F.col("v").between(lo, hi)).groupBy("v").agg(F.count("*").alias("n")).orderBy("v").collect()
    for r in values:
        if rank < r["n"]:
            return r["v"]
        rank -= r["n"]
    raise ValueError("no such rank")


def duration_stats(df: DataFrame, value: str) -> DataFrame:
    """Count, max, min, mean, exact median and sample deviation (0 for one row) in one row.

    The median is found by narrowing a range of values, so no task sorts all of them. NaN counts as
    larger than any number, and an infinite range is sorted as it is.
    """
    v = F.col(value).cast("double")
    out = df.agg(F.count(v).alias("n"), F.max(v).alias("max"), F.min(v).alias("min"), F.avg(v).alias("mean"), F.coalesce(F.stddev_samp(v), F.lit(0.0)).alias("stdev"))
    row = out.first()
    if row["n"] and all(map(math.isfinite, (row["min"], row["max"]))):
        values = df.select(v.alias("v")).where("v is not null")
        middle = {_at_rank(values, (row["n"] - 1) // 2), _at_rank(values, row["n"] // 2)}
        median = F.lit(sum(middle) / len(middle))
        one = df.sparkSession.range(1).select(*[F.lit(row[c]).alias(c) for c in ("n", "max", "min", "mean", "stdev")], median.alias("median"))
        return one.select(F.col("n").cast("long").alias("n"), "max", "min", "mean", "median", "stdev")
    return df.agg(F.count(v).alias("n"), F.max(v).alias("max"), F.min(v).alias("min"), F.avg(v).alias("mean"), F.median(v).alias("median"), F.coalesce(F.stddev_samp(v), F.lit(0.0)).alias("stdev"))


def histogram(df: DataFrame, value: str, bins: int = BINS) -> DataFrame:
    """``(bin, low, high, n)`` of all bins, empty ones too; the last is closed.

    Equal values make one bin with all of them. An empty table has no bins.
    """
    v = F.col(value).cast("double")
    lo, hi = df.agg(F.min(v), F.max(v)).first()
    width = 0.0 if lo is None else (hi - lo) / bins
    place = F.least(F.floor((v - lo) / width), F.lit(bins - 1)) if width else F.lit(0)
    counts = df.where(v.isNotNull()).groupBy(place.cast("int").alias("bin")).agg(F.count("*").alias("n"))
    every = df.sparkSession.range(0 if lo is None else bins if width else 1).select(F.col("id").cast("int").alias("bin"))
    out = every.join(F.broadcast(counts), "bin", "left")  # at most a row a bin
    low, high = (F.lit(lo) + F.col("bin") * width, F.lit(lo) + (F.col("bin") + 1) * width) if width else (F.lit(lo).cast("double"), F.lit(hi).cast("double"))
    return out.select("bin", low.alias("low"), high.alias("high"), F.coalesce("n", F.lit(0)).alias("n"))


def render_histogram(rows: list, width: int = 50) -> str:
    """Lines of text from the collected bins."""
    most = max((r["n"] for r in rows), default=0)
    return "\n".join(f"{r['low']:10.2f} - {r['high']:10.2f} | {'#' * round(width * r['n'] / most) if most else ''} {r['n']}" for r in sorted(rows, key=lambda r: r["bin"]))


def save_histogram_png(rows: list, stats: dict, path: str) -> bool:
    """Draw the bins if the plotting library is there; whether it was."""
    try:
        import matplotlib

        matplotlib.use("Agg")
        from matplotlib import pyplot as plt
    except ImportError:
        return False
    fig, ax = plt.subplots(figsize=(10, 6))
    rows = sorted(rows, key=lambda r: r["bin"])
    ax.bar([r["low"] for r in rows], [r["n"] for r in rows], width=[r["high"] - r["low"] or 1.0 for r in rows], align="edge")
    ax.text(0.98, 0.98, "\n".join(f"{k}: {v:.2f}" for k, v in stats.items()), transform=ax.transAxes, ha="right", va="top")
    fig.savefig(path)
    plt.close(fig)
    return True
