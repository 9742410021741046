"""How sure it is that one model's R² is above another's, on the same titles."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee import vocabulary as V

REPLICATES = 200
_SPACE = 1 << 32
# Multipliers of a 32-bit mix.
STEP, MIX = 0x9E3779B9, 0x45D9F3B


def poisson_cuts() -> list[int]:
    """Below the first of these 32-bit numbers the weight is 0, below the next 1, and so on."""
    cuts, share, total = [], math.exp(-1), 0.0
    for k in range(1, 13):
        total += share
        cuts.append(int(total * _SPACE))
        share /= k
    return cuts


def weight(hashed: Column, replicate: Column) -> Column:
    """How often a replicate has a row: a Poisson number of mean 1, settled by key and replicate.

    ``hashed`` comes from ``key_hash``. Replicate 0 has every row once. Each step of the mix reads its
    number twice, so it goes through a list of one, which is worked out once.
    """
    def mix(x: Column) -> Column:
        return (F.shiftright(x, 16).bitwiseXOR(x) * MIX) % _SPACE

    cuts = F.array(*[F.lit(c).cast("long") for c in poisson_cuts()])
    numbers = F.transform(F.transform(F.array((hashed + replicate * STEP) % _SPACE), mix), mix)
    last = F.transform(numbers, lambda x: F.shiftright(x, 16).bitwiseXOR(x))
    drawn = F.element_at(F.transform(last, lambda x: F.size(F.filter(cuts, lambda c: x >= c))), 1)
    return F.when(replicate == 0, 1).otherwise(drawn)


def key_hash(key: Column, seed: int = V.SEED) -> Column:
    """A 32-bit number for each key."""
    text = F.concat(F.lit(f"{seed}:"), key.cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def paired_bootstrap(predicted: DataFrame, label: str, first: str, second: str, key: str = "tconst",
                     replicates: int = REPLICATES, low: float = 0.025, high: float = 0.975) -> DataFrame:
    """R² of both predictions, their difference, and the interval that most replicates' differences lie in.

    All replicates draw the same rows for both, so what both find hard cancels out. One aggregate
    does it: a row per task and replicate is shuffled. Rows without a label or a prediction go.
    """
    y, a, b = (F.col(c).cast("double") for c in (label, first, second))
    rows = predicted.filter(y.isNotNull() & a.isNotNull() & b.isNotNull()).select(
        key_hash(F.col(key)).alias("hashed"), y.alias("y"), ((y - a) * (y - a)).alias("ea"), ((y - b) * (y - b)).alias("eb"))
    drawn = rows.withColumn("replicate", F.explode(F.sequence(F.lit(0), F.lit(replicates)))).withColumn(
        "w", weight(F.col("hashed"), F.col("replicate").cast("long")))
    w = F.col("w")
    sums = drawn.filter(w > 0).groupBy("replicate").agg(
        F.sum(w).alias("n"), F.sum(w * F.col("y")).alias("y"), F.sum(w * F.col("y") * F.col("y")).alias("yy"),
        F.sum(w * F.col("ea")).alias("ea"), F.sum(w * F.col("eb")).alias("eb"))
    spread = F.col("yy") - F.col("y") * F.col("y") / F.col("n")
    scores = sums.select("replicate", "n", *[
        (1 - F.try_divide(F.col(e), spread)).alias(name) for e, name in (("ea", "a"), ("eb", "b"))])
    gain = F.when(F.col("replicate") > 0, F.col("b") - F.col("a"))
    whole = {c: F.max(F.when(F.col("replicate") == 0, F.col(c))) for c in ("n", "a", "b")}
    return scores.agg(
        whole["n"].alias("rows"), whole["a"].alias("first_r2"), whole["b"].alias("second_r2"),
        (whole["b"] - whole["a"]).alias("gain"), F.percentile(gain, low).alias("low"),
        F.percentile(gain, high).alias("high"), F.avg((gain > 0).cast("double")).alias("share_above"))
