"""Equal-width bins over the range seen in the training data."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class EqualWidthBins:
    """``count`` right-closed bins of equal width between ``low`` and ``high``.

    Fitting reads one aggregate row; applying is a plain expression, so it neither
    shuffles nor joins. Values outside the fitted range go to the first or last bin,
    which is what a model meets at scoring time.
    """

    low: float
    high: float
    count: int = 10

    @classmethod
    def fit(cls, df: DataFrame, column: str, count: int = 10) -> EqualWidthBins:
        row = df.agg(F.min(column).alias("low"), F.max(column).alias("high")).first()
        if row.low is None:
            raise ValueError(f"cannot fit bins: column {column} holds no values")
        return cls(float(row.low), float(row.high), count)

    def index(self, value: Column) -> Column:
        if self.high == self.low:  # one distinct value: it lies in the middle
            return F.when(value.isNotNull(), F.lit(float((self.count - 1) // 2)))
        position = (value - self.low) / (self.high - self.low) * self.count
        # greatest/least skip nulls, so a missing value is kept missing by hand
        inside = F.greatest(F.least(F.ceil(position) - 1, F.lit(self.count - 1)), F.lit(0))
        return F.when(value.isNotNull(), inside.cast("double"))

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @classmethod
    def from_json(cls, text: str) -> EqualWidthBins:
        return cls(**json.loads(text))


def integer_log_bin(votes_log: Column) -> Column:
    """The bin the published scoring service uses: whole part of the log, at most 9."""
    return F.least(F.floor(votes_log), F.lit(9)).cast("double")
