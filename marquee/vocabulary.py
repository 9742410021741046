"""Names, thresholds and constants shared by every operator."""

from __future__ import annotations

# --- fixed values ---------------------------------------------------------
# All values and names in this file must equal the published ones, or results would differ.

GENRES = [
    "Drama", "Comedy", "Thriller", "Romance", "Action",
    "Horror", "Crime", "Documentary", "Adventure", "Sci-Fi",
    "Family", "Fantasy", "Mystery", "Biography", "Animation",
]

MOVIE_TYPE = "movie"
DIRECTOR_CATEGORY = "director"
NULL_MARKER = r"\N"

FIRST_YEAR, LAST_YEAR = 1900, 2024
MIN_VOTES = 10
LOWEST_RATING, HIGHEST_RATING = 1.0, 10.0
HIGH_RATING = 7.0

RATING_CUTS, RATING_TIERS = [5.0, 7.0, 8.0], ["poor", "average", "good", "excellent"]
RUNTIME_CUTS, RUNTIME_BUCKETS = [90, 120], ["short", "standard", "long"]
VOTE_CUTS, VOTE_TIERS = [1000, 10000, 100000], ["obscure", "known", "popular", "blockbuster"]

TYPICAL_RUNTIME = 95.0
RUNTIME_SCALE = 180.0
VOTES_SCALE = 100000.0
RELIABLE_VOTES = 50000
SEED = 42

UNKNOWN_DIRECTOR = {
    "director_avg_rating": 6.0,
    "director_movie_count": 1,
    "director_hit_rate": 0.3,
    "director_votes_log": 5.0,
    "has_known_director": 0,
    "director_max_rating": 6.0,
}

REQUEST_DEFAULTS = {
    "year": 2000,
    "runtime": 95,
    "num_votes": 1000,
    "director_avg_rating": 6.0,
    "director_hit_rate": 0.3,
}
# The command-line client assumes a somewhat better director.
CLIENT_DEFAULTS = {**REQUEST_DEFAULTS, "director_avg_rating": 6.5, "director_hit_rate": 0.4}
# What a scoring request cannot say about its director.
ASSUMED_MOVIE_COUNT = 10
ASSUMED_DIRECTOR_VOTES = 500000


def flag_name(genre: str) -> str:
    return "genre_" + genre.lower().replace("-", "_")


GENRE_FLAGS = [flag_name(g) for g in GENRES]

ID_COLUMNS = ["tconst", "primarytitle", "startyear", "target_rating", "is_high_rated"]

ERA_FEATURES = [
    "year_normalized", "is_modern", "is_classic",
    "decade_2000s", "decade_2010s", "decade_2020s",
]
RUNTIME_FEATURES = ["runtime_normalized", "is_short_film", "is_epic"]
VOTE_FEATURES = ["votes_log", "votes_normalized", "is_well_known", "is_blockbuster"]
POPULARITY_FEATURES = ["votes_log_squared", "votes_log_binned", "popularity_score"]
GENRE_PAIR_FEATURES = [
    "is_drama_or_biography", "is_action_adventure", "is_horror_thriller",
    "long_drama", "classic_documentary", "modern_documentary",
]
DIRECTOR_FEATURES = [
    "director_avg_rating", "director_movie_count", "director_hit_rate",
    "director_votes_log", "has_known_director", "director_max_rating",
]

# The order of features is part of the training export. The three sets models are
# trained on have 28, 37 and 43 columns.
BASE_FEATURES = GENRE_FLAGS + ERA_FEATURES + RUNTIME_FEATURES + VOTE_FEATURES
INTERACTION_FEATURES = BASE_FEATURES + POPULARITY_FEATURES + GENRE_PAIR_FEATURES
FULL_FEATURES = INTERACTION_FEATURES + DIRECTOR_FEATURES

# Flags, and a measure of the year.
PLAIN_FEATURES = GENRE_FLAGS + ERA_FEATURES + ["is_short_film", "is_epic", "is_well_known", "is_blockbuster"]

CLEANED_COLUMNS = [
    "tconst", "primarytitle", "originaltitle", "startyear", "decade",
    "runtimeminutes", "runtime_bucket", "genres", "isadult",
    "averagerating", "numvotes", "rating_tier", "is_high_rated", "vote_tier",
]
SUMMARY_COLUMNS = [
    "tconst", "primarytitle", "startyear", "decade", "genres", "averagerating",
    "numvotes", "rating_tier", "is_high_rated", "runtime_bucket", "vote_tier",
]
# --------------------------------------------------------------------------
