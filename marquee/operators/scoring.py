"""Scoring rating requests, in batch or on a stream.

Every function is a narrow transformation, so the same code serves ``read`` and
``readStream``. A predictor is any function that adds a ``prediction`` column, such as
``RatingModel.transform``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee import vocabulary as V
from marquee.functions import features as X
from marquee.functions.bins import EqualWidthBins, integer_log_bin
from marquee.operators.cleaning import rating_tier
from marquee.operators.joins import balanced_left_join

Predictor = Callable[[DataFrame], DataFrame]

REQUEST_TYPES = {
    "genres": "string", "year": "int", "runtime": "int", "num_votes": "int",
    "director_avg_rating": "double", "director_hit_rate": "double",
}
GENRES_MISSING = "genres field required"


def parse_requests(df: DataFrame, column: str = "request") -> DataFrame:
    """Read JSON requests into typed columns and say in ``error`` what is wrong.

    Every row is checked: text that is not one JSON object, or names a field twice, is refused.
    A field that is absent stays null and later gets its default; without genres there is
    nothing to rate. A field that is present but null, or cannot be read as its type, is an
    error. Numbers may be written as text; decimals of a whole number are cut off if it is a
    number, and refused if it is text.
    """
    names = list(REQUEST_TYPES)
    # What follows a value is not looked at, so it is put into a list and into an object: text
    # after it that would pass in the one does not pass in the other.
    text = F.col(column)
    in_list = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))
    in_object = F.try_parse_json(F.concat(F.lit('{"":'), text, F.lit(',"-":0}')))
    checked = F.try_variant_get(F.when(in_object.isNotNull(), in_list), "$[0]", "variant")
    # a generated row, below which no filter or field is moved: the text is parsed here alone
    read = df.select("*", F.explode(F.array(checked)).alias("_value"))
    kinds = F.schema_of_variant("_value")
    read = read.withColumn("_parsed", F.when(kinds.startswith("OBJECT"), F.col("_value")))
    parsed = {n: F.try_variant_get("_parsed", f"$.{n}", kind) for n, kind in REQUEST_TYPES.items()}
    held = {n: F.try_variant_get("_parsed", f"$.{n}", "variant") for n in names}
    present = {n: held[n].isNotNull() for n in names}
    # genres must be text: any other value would be read as its JSON
    parsed["genres"] = F.when(F.schema_of_variant(held["genres"]) == "STRING", parsed["genres"])
    invalid = F.when(F.col("_parsed").isNull(), "request is not valid JSON")
    missing = F.when(~present["genres"], GENRES_MISSING)
    unreadable = [F.when(present[n] & F.col(n).isNull(), f"{n} cannot be read") for n in names]
    return (
        read.withColumns(parsed)
        .withColumn("error", F.coalesce(invalid, missing, *unreadable))
        .drop("_parsed", "_value")
    )


def validate(requests: DataFrame) -> DataFrame:
    """Set ``error`` on typed requests without genres."""
    return requests.withColumn("error", F.when(F.col("genres").isNull(), GENRES_MISSING))


def accepted(requests: DataFrame) -> DataFrame:
    return requests.filter(F.col("error").isNull()).drop("error")


def rejected(requests: DataFrame) -> DataFrame:
    """Refused requests with the status a service would answer: 400 or 500."""
    status = F.when(F.col("error") == GENRES_MISSING, 400).otherwise(500)
    return requests.filter(F.col("error").isNotNull()).withColumn("status_code", status)


def request_field(requests: DataFrame, name: str, defaults: dict = V.REQUEST_DEFAULTS) -> Column:
    default = F.lit(defaults[name])
    if name not in requests.columns:
        return default
    return F.coalesce(F.col(name), default)


# Where ``look_up_directors`` puts what is known of a director.
DIRECTOR = "_director"


def look_up_directors(requests: DataFrame, stats: DataFrame, key: str = "director_id") -> DataFrame:
    """Bring the reputation of the director a request names; ``score_features`` then uses it.

    Requests without a director, or with one that ``stats`` does not have, keep their own figures or
    the assumed ones. Very many requests may name one director, or none.
    """
    kinds = {"director_movie_count": "long", "has_known_director": "int"}
    held = F.struct(*[F.col(c).cast(kinds.get(c, "double")).alias(c) for c in V.DIRECTOR_FEATURES])
    known = stats.select(F.col("director_id").alias(key), held.alias(DIRECTOR))
    plain = [f"`{c}`" for c, kind in requests.dtypes if not kind.startswith(("struct", "array", "map", "variant"))]
    tagged = requests.withColumn("_spread", F.xxhash64(*plain))
    return balanced_left_join(tagged, known, key, "_spread").drop("_spread")


def known_or(requests: DataFrame, feature: str, assumed: Column) -> Column:
    """What was looked up of a request's director, else what is assumed."""
    return F.coalesce(F.col(f"{DIRECTOR}.{feature}"), assumed) if DIRECTOR in requests.columns else assumed


def score_features(requests: DataFrame, bins: EqualWidthBins | None = None,
                   variant: str = "training") -> DataFrame:
    """The 43 model features of each request, after its own columns.

    ``variant`` settles where the published code disagrees with itself:

    - ``training``: the vote bin and popularity score of the training data (needs the
      model's ``bins``); the choice for a model trained here.
    - ``service``: whole part of the log as bin, no third popularity term.
    - ``client``: the same bin, a third popularity term from 10,000 votes on, other
      defaults for the director, and ratings that are not kept from 1 to 10.
    """
    if variant not in ("training", "service", "client"):
        raise ValueError(f"unknown variant: {variant}")
    if variant == "training" and bins is None:
        raise ValueError("the training variant needs the bins saved with the model")

    defaults = V.CLIENT_DEFAULTS if variant == "client" else V.REQUEST_DEFAULTS
    fields = {name: request_field(requests, name, defaults) for name in defaults}
    average = fields["director_avg_rating"]
    director = {
        "director_avg_rating": average,
        "director_movie_count": F.lit(V.ASSUMED_MOVIE_COUNT),
        "director_hit_rate": fields["director_hit_rate"],
        "director_votes_log": F.log(F.lit(float(V.ASSUMED_DIRECTOR_VOTES + 1))),
        "has_known_director": F.lit(1),
        "director_max_rating": F.least(average + 1.0, F.lit(V.HIGHEST_RATING)),
    }
    base = requests.withColumns({
        **X.genre_flags(F.col("genres")),
        **X.era_features(fields["year"]),
        **X.runtime_features(fields["runtime"]),
        **X.vote_features(fields["num_votes"]),
        **{name: known_or(requests, name, assumed) for name, assumed in director.items()},
    })
    derived = X.interaction_features()
    if variant == "training":
        derived["votes_log_binned"] = bins.index(F.col("votes_log"))
    else:
        derived["votes_log_binned"] = integer_log_bin(F.col("votes_log"))
        third = F.lit(False) if variant == "service" else F.col("is_well_known") == 1
        derived["popularity_score"] = X.popularity_score(third)
    return base.withColumns(derived)


def bounded_rating(prediction: Column) -> Column:
    low, high = F.lit(V.LOWEST_RATING), F.lit(V.HIGHEST_RATING)
    return F.round(F.greatest(low, F.least(high, prediction)), 2)


def with_response(predicted: DataFrame, variant: str = "training") -> DataFrame:
    """Turn ``prediction`` into the rating, flag and tier of a response.

    The client variant rounds the prediction and leaves it where it is; the others keep it
    from 1 to 10.
    """
    rating = F.col("predicted_rating")
    prediction = F.col("prediction")
    answer = F.round(prediction, 2) if variant == "client" else bounded_rating(prediction)
    return (
        predicted.withColumn("predicted_rating", answer)
        .withColumns({
            "is_high_rated": rating >= V.HIGH_RATING,
            "confidence_tier": rating_tier(rating),
        })
    )


def score_requests(requests: DataFrame, predict: Predictor,
                   bins: EqualWidthBins | None = None, variant: str = "training") -> DataFrame:
    """Requests with their response; the features are dropped again."""
    own = [c for c in requests.columns if c not in ("prediction", "predicted_rating")]
    hidden = {c: f"_in_{c}" for c in own if c in V.FULL_FEATURES}
    kept = requests.withColumns({h: F.col(c) for c, h in hidden.items()})
    scored = with_response(predict(score_features(kept, bins, variant)), variant)
    restored = [F.col(hidden[c]).alias(c) if c in hidden else F.col(c) for c in own if c != DIRECTOR]
    return scored.select(*restored, "predicted_rating", "is_high_rated", "confidence_tier")


def response_json(scored: DataFrame, request: str = "request") -> DataFrame:
    """Add status and response as JSON, with the request repeated as it came as ``input``.

    The request has been checked, so its text goes into the response without being read again.
    """
    body = F.to_json(F.struct("predicted_rating", "is_high_rated", "confidence_tier"))
    opened = F.expr("substring(_body, 1, length(_body) - 1)")
    return (
        scored.withColumn("_body", body)
        .withColumn("response", F.concat(opened, F.lit(',"input":'), F.col(request), F.lit("}")))
        .withColumn("status_code", F.lit(200)).drop("_body")
    )


def error_json(requests: DataFrame) -> DataFrame:
    """Refused requests with status and the error as JSON."""
    body = F.to_json(F.struct("error"))
    return rejected(requests).withColumn("response", body)


def scoring_error(scored: DataFrame, actual: str = "actual") -> DataFrame:
    """Absolute error against a known rating; null where it is unknown."""
    return scored.withColumn("error", F.abs(F.col(actual) - F.col("predicted_rating")))
