"""Label a number by the band it falls into."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def band(value: Column | str, cuts: Sequence[float], labels: Sequence[str],
         closed: str | Sequence[str] = "left", missing: str | None = None,
         low: float | None = None, high: float | None = None) -> Column:
    """Map ``value`` to one of ``len(cuts) + 1`` labels.

    ``closed="left"`` puts a value equal to a cut into the band above it,
    ``"right"`` into the band below; a sequence says so cut by cut. ``low`` (open) and
    ``high`` (included) bound the outer bands; beyond them, and for null, the label is
    ``missing``.
    """
    if len(labels) != len(cuts) + 1:
        raise ValueError("need exactly one label more than cuts")
    sides = [closed] * len(cuts) if isinstance(closed, str) else list(closed)
    if len(sides) != len(cuts) or not set(sides) <= {"left", "right"}:
        raise ValueError("closed must be 'left' or 'right', once or per cut")
    v = F.col(value) if isinstance(value, str) else value

    outside = v.isNull()
    if low is not None:
        outside = outside | (v <= low)
    if high is not None:
        outside = outside | (v > high)
    result = F.when(outside, F.lit(missing))
    for cut, side, label in zip(cuts, sides, labels):
        result = result.when(v < cut if side == "left" else v <= cut, label)
    return result.otherwise(labels[-1])
