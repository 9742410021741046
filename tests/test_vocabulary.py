"""The names and limits that results are stated in, written out once more.

The SQL that queries are checked against takes its lists from the vocabulary, so a name missing
there would be missing on both sides.
"""

from marquee import vocabulary as V

GENRES = ("Drama Comedy Thriller Romance Action Horror Crime Documentary Adventure Sci-Fi Family Fantasy "
          "Mystery Biography Animation").split()
ERAS = "year_normalized is_modern is_classic decade_2000s decade_2010s decade_2020s".split()
LENGTHS = "runtime_normalized is_short_film is_epic".split()
VOTES = "votes_log votes_normalized is_well_known is_blockbuster".split()
POPULARITY = "votes_log_squared votes_log_binned popularity_score".split()
PAIRS = ("is_drama_or_biography is_action_adventure is_horror_thriller long_drama classic_documentary "
         "modern_documentary").split()
DIRECTORS = ("director_avg_rating director_movie_count director_hit_rate director_votes_log has_known_director "
             "director_max_rating").split()


def test_genres():
    assert V.GENRES == GENRES
    assert V.GENRE_FLAGS == ["genre_" + g.lower().replace("-", "_") for g in GENRES]


def test_features():
    assert V.BASE_FEATURES == [*V.GENRE_FLAGS, *ERAS, *LENGTHS, *VOTES]
    assert sorted(V.INTERACTION_FEATURES) == sorted([*V.BASE_FEATURES, *POPULARITY, *PAIRS])
    assert sorted(V.FULL_FEATURES) == sorted([*V.BASE_FEATURES, *POPULARITY, *PAIRS, *DIRECTORS])
    assert (len(V.BASE_FEATURES), len(V.INTERACTION_FEATURES), len(V.FULL_FEATURES)) == (28, 37, 43)
    assert V.ID_COLUMNS == ["tconst", "primarytitle", "startyear", "target_rating", "is_high_rated"]


def test_tiers_and_columns():
    assert V.RATING_TIERS == ["poor", "average", "good", "excellent"]
    assert V.RUNTIME_BUCKETS == ["short", "standard", "long"]
    assert V.VOTE_TIERS == ["obscure", "known", "popular", "blockbuster"]
    assert sorted(V.CLEANED_COLUMNS) == sorted(
        "tconst primarytitle originaltitle startyear decade runtimeminutes runtime_bucket genres isadult "
        "averagerating numvotes rating_tier is_high_rated vote_tier".split())
