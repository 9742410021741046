"""Genres as tokens of a fitted vocabulary, where flags look for fixed names within the text."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def tokens(genres: str = "genres") -> Column:
    """The distinct names of a list like ``Drama,War``; none of a missing one."""
    names = F.transform(F.split(F.coalesce(F.col(genres), F.lit("")), ","), lambda n: F.trim(n))
    return F.array_distinct(F.filter(names, lambda n: n != ""))


@dataclass(frozen=True)
class GenreTokens:
    """The names known, by how many titles have them; vectors have a place for each."""

    vocabulary: list[str]

    @classmethod
    def fit(cls, titles: DataFrame, size: int, least: int = 1) -> GenreTokens:
        """The ``size`` names of most titles, ties by name; a row per name is shuffled per task."""
        counted = titles.select(F.explode(tokens()).alias("token")).groupBy("token").count()
        most = counted.filter(F.col("count") >= least).orderBy(F.desc("count"), "token").limit(size)
        return cls([r.token for r in most.collect()])

    def model(self) -> CountVectorizerModel:
        return CountVectorizerModel.from_vocabulary(
            self.vocabulary, inputCol="_tokens", outputCol="genre_vector").setBinary(True)

    def transform(self, titles: DataFrame) -> DataFrame:
        """Add ``genre_vector``, 1 at the place of each name a title has, and how many it has beside."""
        known = F.array(*[F.lit(v) for v in self.vocabulary]).cast("array<string>")
        with_tokens = titles.withColumn("_tokens", tokens())
        vectors = self.model().transform(with_tokens) if self.vocabulary else with_tokens
        return vectors.withColumn("unknown_genres", F.size(F.array_except("_tokens", known))).drop("_tokens")

    def names(self, vector: str = "genre_vector") -> Column:
        """The names that a vector stands for, in order."""
        known = F.array(*[F.lit(v) for v in self.vocabulary])
        both = F.zip_with(known, vector_to_array(F.col(vector)), lambda v, x: F.when(x > 0, v))
        return F.array_sort(F.array_compact(both))

    def save(self, path: str) -> None:
        self.model().write().overwrite().save(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> GenreTokens:
        return cls(list(CountVectorizerModel.load(path).vocabulary))
