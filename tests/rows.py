"""Literal rows used by several tests."""

TITLES = [
    # tconst, titletype, primarytitle, startyear, runtimeminutes, genres
    ("tt01", "movie", "Plain", "1999", "89", "Drama,Crime"),
    ("tt02", "movie", "Edge five", "2000", "90", "Documentary"),
    ("tt03", "movie", "Edge seven", "1969", "120", "Biography"),
    ("tt04", "movie", "Edge eight", "2020", "121", "Action,Adventure,Sci-Fi"),
    ("tt05", "movie", "No runtime", "1900", None, None),
    ("tt06", "movie", "Bad year", "19x9", "100", "Drama"),
    ("tt07", "movie", "No year", None, "100", "Drama"),
    ("tt08", "movie", None, "1999", "100", "Drama"),
    ("tt09", "tvEpisode", "Episode", "2010", "45", "Drama"),
    ("tt10", "movie", "Unrated", "2010", "100", "Drama"),
    ("tt11", "movie", "Few votes", "2010", "100", "Drama"),
    ("tt12", "movie", "Too late", "2025", "100", "Drama"),
    ("tt13", "movie", "Long drama", "2015", "151", "Drama,Horror"),
]
RATINGS = [
    ("tt01", "4.9", "999"), ("tt02", "5.0", "1000"), ("tt03", "7.0", "10000"),
    ("tt04", "8.0", "100000"), ("tt05", "6.5", "10"), ("tt06", "6.0", "100"),
    ("tt07", "6.0", "100"), ("tt08", "6.0", "100"), ("tt09", "9.0", "5000"),
    ("tt11", "6.0", "9"), ("tt12", "6.0", "100"), ("tt13", "7.9", "49999"),
]
CREDITS = [
    # tconst, ordering, nconst, category
    ("tt01", "2", "nm1", "director"), ("tt01", "1", "nm2", "director"),
    ("tt02", "1", "nm1", "director"), ("tt02", "1", "nm3", "director"),
    ("tt03", "1", "nm1", "director"), ("tt03", "2", "nm9", "actor"),
    ("tt09", "1", "nm2", "director"), ("tt10", "1", "nm7", "director"),
]


def titles(spark):
    df = spark.createDataFrame(
        TITLES,
        "tconst string, titletype string, primarytitle string, startyear string, "
        "runtimeminutes string, genres string",
    )
    return df.selectExpr("*", "primarytitle AS originaltitle", "'0' AS isadult")


def ratings(spark):
    return spark.createDataFrame(RATINGS, "tconst string, averagerating string, numvotes string")


def credits(spark):
    return spark.createDataFrame(
        CREDITS, "tconst string, ordering string, nconst string, category string"
    )


def by_key(df, key="tconst"):
    return {row[key]: row for row in df.collect()}
