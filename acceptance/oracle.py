"""DuckDB SQL giving the results the queries must match.

Each statement is put together from named relations over the given tables. The formulas
are written independently of the library: edges instead of a bin formula, window functions
instead of aggregates, lists instead of chained conditions.
"""

from __future__ import annotations

from marquee import vocabulary as V
from marquee.operators import uncertainty

GENRE_POOL = [*V.GENRES, "Western", "War"]
POOL_SQL = "[" + ", ".join(f"'{g}'" for g in GENRE_POOL) + "]"

TITLES = f"""
  select o_orderkey as tconst,
    case o_orderstatus when 'P' then 'tvEpisode' else 'movie' end as titletype,
    case when o_orderkey % 97 <> 0 then 'Title ' || o_orderkey end as primarytitle,
    case when o_orderkey % 97 <> 0 then 'TITLE ' || o_orderkey end as originaltitle,
    case when o_orderkey % 89 <> 0 then cast(1890 + o_custkey % 140 as integer) end as startyear,
    case when o_orderkey % 11 <> 0 then cast(20 + o_orderkey % 181 as integer) end
      as runtimeminutes,
    case when o_orderkey % 23 = 0 then null
         when o_orderkey % 3 = 0 then {POOL_SQL}[o_orderkey % 17 + 1]
         else {POOL_SQL}[o_orderkey % 17 + 1] || ',' || {POOL_SQL}[(o_orderkey + 5) % 17 + 1]
    end as genres,
    cast(o_orderkey % 50 = 0 as integer) as isadult
  from orders"""

RATED_ORDERS = """
  select *, cast(floor(o_totalprice) as bigint) as price from orders"""

RATING = "cast((10 + price % 91) / 10.0::double as float)"
VOTES = """cast(case when o_orderkey % 101 = 0 then 49999 when o_orderkey % 103 = 0 then 10000
      when o_orderkey % 107 = 0 then 50000
      else price // [1, 10, 100, 1000, 10000, 100000][o_orderkey % 6 + 1] end as integer)"""

RATINGS = f"""
  select o_orderkey as tconst, {RATING} as averagerating, {VOTES} as numvotes
  from rated_orders where o_orderpriority <> '4-NOT SPECIFIED'"""

ENTRIES = """
  select l_orderkey as tconst, l_linenumber as ordering, l_suppkey as director_id
  from lineitem where l_returnflag = 'A'"""

JOINED = """
  select * from titles join ratings using (tconst) where titletype = 'movie'"""

CLEANED = """
  select tconst, primarytitle, originaltitle, startyear,
    cast(startyear // 10 * 10 as integer) as decade, runtimeminutes,
    case when runtimeminutes is null then 'unknown' when runtimeminutes >= 121 then 'long'
         when runtimeminutes >= 90 then 'standard' else 'short' end as runtime_bucket,
    genres, isadult, averagerating, numvotes,
    case when averagerating < 5 then 'poor' when averagerating < 7 then 'average'
         when averagerating < 8 then 'good' else 'excellent' end as rating_tier,
    cast(averagerating >= 7 as integer) as is_high_rated,
    case when numvotes < 1000 then 'obscure' when numvotes < 10000 then 'known'
         when numvotes < 100000 then 'popular' else 'blockbuster' end as vote_tier
  from joined
  where primarytitle is not null and startyear between 1900 and 2024 and numvotes >= 10
    and averagerating between 1 and 10"""

STATS_RAW = """
  select director_id, count(*) as director_movie_count,
    round(avg(averagerating), 3) as director_avg_rating,
    round(avg(numvotes), 0) as director_avg_votes,
    max(averagerating) as director_max_rating,
    round(avg(case when averagerating >= 7 then 1 else 0 end), 3) as director_hit_rate
  from entries join ratings using (tconst) group by director_id"""

STATS = """
  select *, ln(director_avg_votes + 1) as director_votes_log,
    cast(director_movie_count >= 3 as integer) as has_known_director
  from stats_raw"""

PRIMARY = """
  select tconst, director_id from entries
  qualify row_number() over (partition by tconst order by ordering, director_id) = 1"""

ENRICHED = """
  select c.*, p.director_id,
    coalesce(director_movie_count, 1) as director_movie_count,
    coalesce(director_avg_rating, 6.0::double) as director_avg_rating,
    director_avg_votes,
    coalesce(director_max_rating, 6.0::float) as director_max_rating,
    coalesce(director_hit_rate, 0.3::double) as director_hit_rate,
    coalesce(director_votes_log, 5.0::double) as director_votes_log,
    coalesce(has_known_director, 0) as has_known_director
  from cleaned c left join primaries p using (tconst) left join stats s using (director_id)"""


def base_features(year: str, runtime: str, votes: str) -> str:
    flags = ",\n    ".join(
        f"cast(coalesce(contains(genres, '{g}'), false) as integer) as {V.flag_name(g)}"
        for g in V.GENRES
    )
    return f"""{flags},
    ({year} - 1900) / 124::double as year_normalized,
    cast({year} >= 2000 as integer) as is_modern,
    cast({year} < 1970 as integer) as is_classic,
    cast({year} between 2000 and 2009 as integer) as decade_2000s,
    cast({year} between 2010 and 2019 as integer) as decade_2010s,
    cast({year} >= 2020 as integer) as decade_2020s,
    least(coalesce({runtime}, 95) / 180::double, 1) as runtime_normalized,
    cast(coalesce({runtime}, 95) < 60 as integer) as is_short_film,
    cast(coalesce({runtime}, 95) > 150 as integer) as is_epic,
    ln({votes} + 1) as votes_log,
    least({votes} / 100000::double, 1) as votes_normalized,
    cast({votes} >= 10000 as integer) as is_well_known,
    cast({votes} >= 100000 as integer) as is_blockbuster"""


FEATURES = f"""
  select tconst, primarytitle, startyear, averagerating as target_rating, is_high_rated,
    {base_features('startyear', 'runtimeminutes', 'numvotes')}
  from cleaned"""

VOTE_RANGE = "select min(votes_log) as low, max(votes_log) as high from features"

# a value's bin is the number of inner edges below it
FITTED_BIN = ("(" + " + ".join(
    f"cast(votes_log > low + {k} * (high - low) / 10 as integer)" for k in range(1, 10)
) + ")")
INTEGER_BIN = "least(cast(floor(votes_log) as integer), 9)"

THIRD_TERM = {
    "training": "votes_normalized > 0.1::double",
    "service": "false",
    "client": "is_well_known = 1",
}


def interactions(votes_bin: str, third: str) -> str:
    return f"""votes_log * votes_log as votes_log_squared,
    cast({votes_bin} as double) as votes_log_binned,
    cast(3 * is_blockbuster + 2 * is_well_known + cast({third} as integer) as double)
      as popularity_score,
    greatest(genre_drama, genre_biography) as is_drama_or_biography,
    genre_action * genre_adventure as is_action_adventure,
    greatest(genre_horror, genre_thriller) as is_horror_thriller,
    is_epic * genre_drama as long_drama,
    is_classic * genre_documentary as classic_documentary,
    is_modern * genre_documentary as modern_documentary"""


MATRIX = f"""
  select f.*, {interactions(FITTED_BIN, THIRD_TERM['training'])},
    e.director_avg_rating, e.director_movie_count, e.director_hit_rate,
    e.director_votes_log, e.has_known_director, e.director_max_rating
  from features f join enriched e using (tconst), vote_range"""

SPLIT = """
  select tconst, case when cast('0x' || md5(cast(tconst as varchar))[1:8] as bigint) % 100 < 80
    then 'train' else 'test' end as split
  from cleaned"""

BASELINE = """
  select cast(target_rating as double) as y, director_avg_rating as p
  from matrix join split using (tconst) where split = 'test'"""

REQUESTS = f"""
  select o_orderkey as request_id, t.genres, t.startyear as year, t.runtimeminutes as runtime,
    case when o_orderpriority <> '4-NOT SPECIFIED' then {VOTES} end as num_votes,
    case when o_orderkey % 7 <> 0 then (10 + o_custkey % 91) / 10::double end
      as director_avg_rating,
    case when o_orderkey % 19 <> 0 then (o_custkey % 21) / 20::double end as director_hit_rate,
    case when o_orderpriority <> '4-NOT SPECIFIED' then cast({RATING} as double) end as actual
  from rated_orders join titles t on t.tconst = o_orderkey"""

def filled(average: float, hits: float) -> str:
    return f"""
  select request_id, genres, coalesce(year, 2000) as y, coalesce(runtime, 95) as r,
    coalesce(num_votes, 1000) as v, coalesce(director_avg_rating, {average}::double) as a,
    coalesce(director_hit_rate, {hits}::double) as h
  from requests where genres is not null"""


REQUEST_BASE = f"select *, {base_features('y', 'r', 'v')} from filled"
CLIENT_BASE = f"select *, {base_features('y', 'r', 'v')} from filled_client"

SIMPLE = """
  select request_id, round(least(10, greatest(1, a * 1.25 - 1.5
    + case when v >= 10000 then 0.5 else 0 end)), 2) as predicted_rating
  from filled"""

SCORED = """
  select *, predicted_rating >= 7 as is_high_rated,
    case when predicted_rating < 5 then 'poor' when predicted_rating < 7 then 'average'
         when predicted_rating < 8 then 'good' else 'excellent' end as confidence_tier
  from requests join simple using (request_id)"""

METRICS = """
  select cast(floor(epoch(ts) / 300) * 300 as bigint) as window_start, event_type as job,
    cast(event_type = 'error' as bigint) as failed, value,
    cast(floor(epoch(ts) / 86400) * 86400 as bigint) as day_start
  from events"""

RELATIONS = {
    "titles": TITLES, "rated_orders": RATED_ORDERS, "ratings": RATINGS, "entries": ENTRIES,
    "joined": JOINED, "cleaned": CLEANED, "stats_raw": STATS_RAW, "stats": STATS,
    "primaries": PRIMARY, "enriched": ENRICHED, "features": FEATURES, "vote_range": VOTE_RANGE,
    "matrix": MATRIX, "split": SPLIT, "baseline": BASELINE, "requests": REQUESTS,
    "filled": filled(6.0, 0.3), "filled_client": filled(6.5, 0.4), "request_base": REQUEST_BASE,
    "client_base": CLIENT_BASE, "simple": SIMPLE, "scored": SCORED,
    "metrics": METRICS,
}


def sql(body: str) -> str:
    """Put the relations before a statement. DuckDB ignores those it does not use."""
    parts = ",\n".join(f"{name} as ({text})" for name, text in RELATIONS.items())
    return f"with {parts}\n{body}"


def columns(names: list[str]) -> str:
    """Column list with logarithms rounded as the queries round them."""
    logs = ("votes_log", "votes_log_squared", "director_votes_log")
    return ", ".join(f"round({n}, 9) as {n}" if n in logs else n for n in names)


def group(by: str, measures: str, where: str = "true", having: str = "true",
          tail: str = "") -> str:
    keys = f"{by}, " if by else ""
    grouping = f"group by {by} having {having}" if by else ""
    return sql(f"select {keys}{measures} from cleaned where {where} {grouping} {tail}")


def full(share: str, digits: int) -> str:
    return f"round(cast(count({share}) as double) * 100 / count(*), {digits})"


COUNT = "count(*) as movie_count"
RATING_2 = "round(avg(averagerating), 2) as avg_rating"
VOTE_SUM = "cast(sum(numvotes) as bigint) as total_votes"
HIGH_SUM = "cast(sum(is_high_rated) as bigint) as high_rated_count"
GENRES_BEST = "order by avg_rating desc, genres asc nulls last"

CLEANED_SQL = sql("select * from cleaned")
MATRIX_COLUMNS = V.ID_COLUMNS + V.FULL_FEATURES
MATRIX_SQL = sql(f"select {columns(MATRIX_COLUMNS)} from matrix")
SPLIT_SQL = sql("select * from split")
SAMPLE_ORDER = "order by md5('42:' || tconst), tconst limit 1000"
METRIC_SUMS = """select window_start, job, cast(sum(1 - failed) as bigint) as completed,
  cast(sum(failed) as bigint) as failed from metrics group by all"""
ALARMS_SQL = sql(METRIC_SUMS + " having sum(metrics.failed) >= 1")
REGRESSION_SQL = sql("""select count(*) as test_rows,
  round(sqrt(avg((y - p) * (y - p))), 6) as rmse,
  round(1 - sum((y - p) * (y - p)) / sum((y - mean) * (y - mean)), 6) as r2,
  round(avg(abs(y - p)), 6) as mae
  from baseline, (select avg(y) as mean from baseline)""")
SCORED_SQL = sql("select *, round(abs(actual - predicted_rating), 6) as error from scored")


def request_features(variant: str) -> str:
    votes_bin = FITTED_BIN if variant == "training" else INTEGER_BIN
    source = "client_base" if variant == "client" else "request_base"
    directors = """a as director_avg_rating, 10 as director_movie_count,
    h as director_hit_rate, ln(500001) as director_votes_log, 1 as has_known_director,
    least(a + 1, 10) as director_max_rating"""
    return sql(f"""select {columns(['request_id', *V.FULL_FEATURES])} from (
  select *, {interactions(votes_bin, THIRD_TERM[variant])}, {directors}
  from {source}, vote_range)""")


TIER_BINS = {
    "rating_tier": ("averagerating", [0, 5, 7, 8, 10], V.RATING_TIERS),
    "runtime_bucket": ("runtimeminutes", [0, 90, 120, 9999], V.RUNTIME_BUCKETS),
    "vote_tier": ("numvotes", [0, 1000, 10000, 100000, None], V.VOTE_TIERS),
}


def right_closed() -> str:
    parts = []
    for name, (value, edges, labels) in TIER_BINS.items():
        cases = " ".join(
            f"when {value} > {low}" + (f" and {value} <= {high}" if high else "")
            + f" then '{label}'" for low, high, label in zip(edges, edges[1:], labels)
        )
        parts.append(f"case {cases} end as {name}")
    return sql(f"select tconst, {', '.join(parts)} from cleaned")


# The text of a request, as it was written; the first case whose number divides request_id.
PLAIN_TEXT = """'{ ' || concat_ws(', ', '"runtime" : ' || runtime, '"genres": "' || genres || '"',
  '"num_votes":' || num_votes, '"director_avg_rating":' || director_avg_rating,
  '"note": {"b": 1.0, "a": [1, 2]}', '"director_hit_rate": ' || director_hit_rate,
  '"year":"' || year || '"') || '}'"""
DECIMAL_TEXT = """'{ "year" : 1990.7 , "genres" : "War" }'"""
REFUSED = [
    (29, "request is not valid JSON", 500), (31, "request is not valid JSON", 500),
    (37, "request is not valid JSON", 500), (41, "request is not valid JSON", 500),
    (43, "genres cannot be read", 500), (47, "year cannot be read", 500),
    (53, "year cannot be read", 500), (59, "runtime cannot be read", 500), (61, None, 200),
    (67, "genres cannot be read", 500), (71, "genres field required", 400),
]


def refused(item: int) -> str:
    """Of a request's error (1) or status (2), by its number."""
    cases = " ".join(
        f"when request_id % {r[0]} = 0 then " + ("null" if r[item] is None else repr(r[item])) for r in REFUSED)
    rest = "'genres field required'" if item == 1 else "400"
    return f"case {cases} when genres is null then {rest} else {'null' if item == 1 else '200'} end"


# The versions: name, population, features, rounds; and the rows they are fitted and tested on.
FITS = """select version, population, n_features, rounds,
    count(*) filter (where split = 'train') as train_rows,
    count(*) filter (where split = 'test') as test_rows, true as sound
  from (values ('v1', 'all', 28, 200), ('v2', 'all', 37, 500), ('v3', 'reliable', 37, 500),
      ('v4-full', 'all', 43, 500), ('v4-filtered', 'reliable', 43, 500))
      v(version, population, n_features, rounds)
    join (select tconst, split, numvotes >= 49999 as reliable from cleaned join split using (tconst))
      on population = 'all' or reliable
  group by version, population, n_features, rounds"""
FITS = f"select * from ({FITS})"
PREDICTED = """select tconst, primarytitle, averagerating as actual, true as agrees
  from cleaned join split using (tconst) where split = 'test'"""
# one split: the flag that leaves the least squared error, and the mean on either side of it
STUMP = f"""select tconst, round(case when on_side then mean_on else mean_off end, 6) as predicted from (
  select * from (
    select t.tconst, t.flag, t.set as on_side, best.mean_on, best.mean_off
    from (unpivot (select tconst, split, {{flags}} from features join split using (tconst)) on {{names}}
          into name flag value set) t
    join (
      select flag, avg(y) filter (where set = 1) as mean_on, avg(y) filter (where set = 0) as mean_off
      from (unpivot (select cast(target_rating as double) as y, {{flags}} from features
            join split using (tconst) where split = 'train') on {{names}} into name flag value set)
      group by flag
      order by power(sum(y) filter (where set = 1), 2) / count(*) filter (where set = 1)
        + power(sum(y) filter (where set = 0), 2) / count(*) filter (where set = 0) desc nulls last
      limit 1) best using (flag)
    where split = 'test'))"""
STUMP = STUMP.format(flags=", ".join(V.GENRE_FLAGS), names=", ".join(V.GENRE_FLAGS))


DIRECTED = sql("""select request_id, coalesce(s.director_avg_rating, a) as director_avg_rating,
  coalesce(s.director_movie_count, 10) as director_movie_count, coalesce(s.director_hit_rate, h) as director_hit_rate,
  round(coalesce(s.director_votes_log, ln(500001)), 9) as director_votes_log,
  coalesce(s.has_known_director, 1) as has_known_director,
  coalesce(cast(s.director_max_rating as double), least(a + 1, 10)) as director_max_rating
  from filled join orders on o_orderkey = request_id left join stats s on s.director_id = case
    when o_orderkey % 11 = 0 then null when o_orderkey % 3 = 0 then 1 else o_custkey % 150 end""")
# reputation without a title's own rating; tenths and votes are whole, so sums are exact
RATED_TITLES = """rated as (select tconst, director_id, cast(round(cast(averagerating as double) * 10) as bigint) as tenths,
    cast(numvotes as bigint) as votes, cast(averagerating >= 7 as integer) as hit
  from (select distinct tconst, director_id from entries) join ratings using (tconst))"""
WITHOUT_OWN = """select tconst, coalesce(n, 1) as director_movie_count,
  coalesce(round(tenths / 10::double / n, 3), 6.0::double) as director_avg_rating,
  coalesce(round(hits / n::double, 3), 0.3::double) as director_hit_rate,
  round(coalesce(ln(round(votes / n::double, 0) + 1), 5.0::double), 9) as director_votes_log,
  coalesce(cast(n >= 3 as integer), 0) as has_known_director,
  coalesce(most / 10::double, 6.0::double) as director_max_rating
  from cleaned left join (
    select c.tconst, count(*) as n, sum(r.tenths)::bigint as tenths, sum(r.votes)::bigint as votes,
      sum(r.hit)::bigint as hits, max(r.tenths) as most
    from cleaned c join primaries p using (tconst) join rated r on r.director_id = p.director_id {}
    group by c.tconst) using (tconst)"""
DIRECTORS_BEFORE = sql("select * from (with " + RATED_TITLES + WITHOUT_OWN.format(
    "join titles t on t.tconst = r.tconst and t.startyear < c.startyear") + ")")
DIRECTORS_OF_OTHERS = sql("select * from (with " + RATED_TITLES + WITHOUT_OWN.format("and r.tconst <> c.tconst") + ")")
# gaps and islands over the failing windows that a watermark closes
TRANSITIONS_SQL = sql("""select * from (with failing as (
    select job, window_start as begins, window_start + 300 as ends from metrics, (
      select cast(floor(epoch(max(ts))) as bigint) - 600 as until from events)
    where window_start + 300 <= until group by job, window_start, until having sum(failed) >= 1),
  near as (select *, lag(ends) over w as earlier, lead(begins) over w as later,
      (select cast(floor(epoch(max(ts))) as bigint) - 600 from events) as until
    from failing window w as (partition by job order by begins))
  select job, begins as at, 'raised' as state from near where earlier is null or begins >= earlier + 1800
  union all
  select job, ends + 1800, 'cleared' from near where coalesce(later, until) >= ends + 1800)""")
FLAG_LIST = ", ".join(V.GENRE_FLAGS)
NAMES = "list_distinct(list_transform(string_split(coalesce(genres, ''), ','), lambda g: trim(g)))"
GENRE_TOKENS = sql(f"""select * from (with names as (
    select tconst, unnest(list_filter({NAMES}, lambda g: g <> '')) as token from cleaned),
  known as (select token from names group by token order by count(*) desc, token limit 12)
  select tconst, coalesce(string_agg(known.token, ',' order by known.token), '') as known,
    cast(count(names.token) filter (known.token is null) as integer) as unknown_genres
  from cleaned left join names using (tconst) left join known using (token) group by tconst)""")


def bootstrap_sql(seed: int = V.SEED) -> str:
    """A number of draws for each row and replicate, by a mix of the key's hash."""
    mixed = f"(cast('0x' || md5('{seed}:' || tconst)[1:8] as bigint) + replicate * {uncertainty.STEP}) % 4294967296"
    rounds = f"""h0 as (select *, {mixed} as x from rows, (select unnest(range(0, {uncertainty.REPLICATES + 1})) as replicate)),
      h1 as (select * replace ((xor(x >> 16, x) * {uncertainty.MIX}) % 4294967296 as x) from h0),
      h2 as (select * replace ((xor(x >> 16, x) * {uncertainty.MIX}) % 4294967296 as x) from h1),
      h3 as (select * replace (xor(x >> 16, x) as x) from h2)"""
    drawn = " + ".join(f"cast(x >= {cut} as integer)" for cut in uncertainty.poisson_cuts())
    return sql(f"""select * from (with rows as (
        select tconst, cast(target_rating as double) as y, director_avg_rating as a, 5 + is_well_known / 2::double as b
        from matrix join split using (tconst) where split = 'test'),
      {rounds},
      w as (select *, case when replicate = 0 then 1 else {drawn} end as w from h3),
      sums as (select replicate, sum(w)::bigint as n, sum(w * y) as y, sum(w * y * y) as yy,
        sum(w * ((y - a) * (y - a))) as ea, sum(w * ((y - b) * (y - b))) as eb from w where w > 0 group by replicate),
      r2 as (select replicate, n, 1 - ea / (yy - y * y / n) as a, 1 - eb / (yy - y * y / n) as b from sums),
      gains as (select b - a as gain from r2 where replicate > 0)
      select n as rows, round(a, 6) as first_r2, round(b, 6) as second_r2, round(b - a, 6) as gain,
        (select round(quantile_cont(gain, 0.025), 6) from gains) as low,
        (select round(quantile_cont(gain, 0.975), 6) from gains) as high,
        (select round(avg(cast(gain > 0 as double)), 6) from gains) as share_above
      from r2 where replicate = 0)""")


# trees in full: sums by node, feature and value, as whole numbers of a unit; the best split of each
# node by the penalised gain; a value for each leaf, added to the predictions before
UNIT = 1 << 20


def trees_sql(features: list[str], rounds: int, depth: int, rate: float, l1: float, l2: float,
              least: int, least_gain: float) -> str:
    def worth(g: str, n: str) -> str:
        part = f"greatest(abs({g}::double / {UNIT}) - {l1}, 0)"
        return f"{part} * {part} / ({n} + {l2})"

    steps = [f"""x as materialized (select tconst, split, cast(target_rating as double) as y,
        unnest([{", ".join(f"cast({f} as double)" for f in features)}]) as x, unnest(range({len(features)})) as f
      from features join split using (tconst))""",
             f"""p0 as materialized (select tconst, split, y, (select sum(cast(round_even(y * {UNIT}, 0) as bigint))
        ::double / {UNIT} / count(*) from x where split = 'train' and f = 0) as predicted from x where f = 0)"""]
    for t in range(rounds):
        steps.append(f"""n{t}_0 as materialized (select tconst, split, 1 as node,
          cast(round_even((predicted - y) * {UNIT}, 0) as bigint) as g from p{t})""")
        for level in range(depth):
            steps.append(f"""s{t}_{level} as materialized (select node, f, x from (
              select node, f, x, {worth("lg", "ln")} + {worth("(tg - lg)", "(tn - ln)")} - {worth("tg", "tn")} as gain
              from (select node, f, x, sum(g) over before as lg, sum(n) over before as ln,
                  sum(g) over whole as tg, sum(n) over whole as tn
                from (select node, f, x, sum(g)::bigint as g, count(*) as n from n{t}_{level} join x using (tconst)
                  where x.split = 'train' and node >= {2 ** level} group by all)
                window before as (partition by node, f order by x rows between unbounded preceding and 1 preceding),
                  whole as (partition by node, f))
              where ln >= {least} and tn - ln >= {least})
              where gain >= {least_gain}
              qualify row_number() over (partition by node order by gain desc, f, x) = 1)""")
            steps.append(f"""n{t}_{level + 1} as materialized (select n.tconst, n.split, n.g, case when s.node is null
                then n.node else 2 * n.node + cast(x.x >= s.x as integer) end as node
              from n{t}_{level} n left join s{t}_{level} s using (node) left join x on x.tconst = n.tconst and x.f = s.f)""")
        steps.append(f"""v{t} as (select node, -{rate} * (sign(g) * greatest(abs(g::double / {UNIT}) - {l1}, 0)
            / (n + {l2})) as value
          from (select node, sum(g)::bigint as g, count(*) as n from n{t}_{depth} where split = 'train' group by node))""")
        steps.append(f"""p{t + 1} as materialized (select p.tconst, p.split, p.y, predicted + value as predicted
          from p{t} p join n{t}_{depth} using (tconst) join v{t} using (node))""")
    return sql("select * from (with " + ",\n".join(steps)
               + f"\nselect tconst, round(predicted, 6) as predicted from p{rounds} where split = 'test')")


# written to text and read back, these get the double nearest to their short form
FLOATS = ("target_rating", "director_max_rating")

ORACLE: dict[str, str] = {
    "etl_clean": CLEANED_SQL,
    "band_right_closed": right_closed(),
    "title_search": sql("select tconst, primarytitle from titles where primarytitle like '%42%'"),
    "rpt_movies_per_decade": group(
        "decade", f"{COUNT}, {RATING_2}, max(numvotes) as max_votes"),
    "rpt_tier_share": sql("""select rating_tier, count(*) as count,
      round(cast(count(*) as double) * 100 / (select count(*) from cleaned), 1) as percentage
      from cleaned group by rating_tier"""),
    "rpt_top_movies": sql("""select primarytitle, startyear, averagerating, numvotes, genres,
      runtime_bucket from cleaned where numvotes >= 50000
      order by averagerating desc, numvotes desc, tconst limit 20"""),
    "rpt_best_genres": group(
        "genres", f"{COUNT}, {RATING_2}, {VOTE_SUM}", "numvotes >= 1000", "count(*) >= 50",
        GENRES_BEST + " limit 20"),
    "rpt_tier_trend": group("decade, rating_tier", "count(*) as count", "decade >= 1960"),
    "rpt_runtime_effect": group(
        "runtime_bucket",
        f"count(*) as count, {RATING_2}, round(avg(numvotes), 0) as avg_votes",
        "runtimeminutes is not null"),
    "panel_totals": group("", f"""count(*) as total_movies, {RATING_2}, {VOTE_SUM},
      cast(sum(is_high_rated) as bigint) as high_rated"""),
    "panel_decade_count": group("decade", COUNT),
    "panel_decade_rating": group("decade", RATING_2),
    "panel_genres": group(
        "genres", f"{COUNT}, {RATING_2}", "numvotes >= 1000", "count(*) >= 20",
        GENRES_BEST + " limit 15"),
    "panel_rating_tier": group("rating_tier", COUNT),
    "panel_vote_tier": group("vote_tier", COUNT),
    "v_decade_stats": group(
        "decade", f"{COUNT}, {RATING_2}, max(averagerating) as max_rating, {VOTE_SUM}, {HIGH_SUM}"),
    "v_genre_stats": group(
        "genres", f"{COUNT}, {RATING_2}, {VOTE_SUM}, {HIGH_SUM}", "numvotes >= 1000",
        "count(*) >= 50"),
    "v_movies_summary": sql(f"select {', '.join(V.SUMMARY_COLUMNS)} from cleaned"),
    "v_top_movies": sql("""select primarytitle, startyear, genres, averagerating, numvotes,
      rating_tier, runtime_bucket from cleaned where numvotes >= 50000"""),
    "top_by_votes": sql("""select primarytitle, startyear, averagerating, numvotes from cleaned
      order by numvotes desc, tconst limit 5"""),
    "dq_completeness": group("", f"""count(*) as total_movies,
      {full('primarytitle', 2)} as title_completeness,
      {full('averagerating', 2)} as rating_completeness,
      {full('numvotes', 2)} as votes_completeness"""),
    "dq_health": group("", f"""count(*) as total_records,
      round(avg(averagerating), 3) as mean_rating, count(distinct decade) as decades_covered,
      {HIGH_SUM}, {full('primarytitle', 2)} as data_completeness_pct"""),
    "dq_by_decade": group("decade", f"""count(*) as records, {RATING_2},
      count(runtimeminutes) as has_runtime, {full('runtimeminutes', 1)} as runtime_completeness"""),
    "stage_counts": sql("""
      select 'titles' as stage, count(*) as row_count from titles
      union all select 'movies', count(*) from titles where titletype = 'movie'
      union all select 'ratings', count(*) from ratings
      union all select 'joined', count(*) from joined
      union all select 'clean', count(*) from cleaned
      union all select 'director_entries', count(*) from entries
      union all select 'directors', count(*) from stats
      union all select 'enriched', count(*) from enriched
      union all select 'features', count(*) from features"""),
    "value_counts": group("rating_tier", "count(*) as count"),
    "value_counts_recent": group("decade", "count(*) as count", "decade >= 1980"),
    "describe_target": sql("""select count(target_rating) as n, min(target_rating) as min,
      max(target_rating) as max, round(avg(target_rating), 6) as mean,
      round(stddev_samp(target_rating), 6) as std from features"""),
    "describe_reliable": sql("""select count(averagerating) as n, min(averagerating) as min,
      max(averagerating) as max, round(avg(averagerating), 6) as mean,
      round(stddev_samp(averagerating), 6) as std from cleaned where numvotes >= 49999"""),
    "genre_flag_totals": sql(
        "select flag, cast(total as bigint) as total from (unpivot (select "
        + ", ".join(f"sum({f}) as {f}" for f in V.GENRE_FLAGS)
        + f" from features) on {', '.join(V.GENRE_FLAGS)} into name flag value total)"
        + " order by total desc, flag limit 8"),
    "flag_counts": sql("""select
      count(*) filter (where runtimeminutes is null) as null_runtimes,
      count(*) filter (where startyear >= 2000) as modern,
      count(*) filter (where startyear < 1970) as classic,
      count(*) filter (where runtimeminutes < 60) as short_films,
      count(*) filter (where runtimeminutes > 150) as epics,
      count(*) filter (where numvotes >= 10000) as well_known,
      count(*) filter (where numvotes >= 100000) as blockbusters,
      count(*) filter (where has_known_director = 1) as known_directors from enriched"""),
    "director_entries": sql("select * from entries"),
    "director_stats": sql(
        "select * replace (round(director_votes_log, 9) as director_votes_log) from stats"),
    "primary_director": sql("select * from primaries"),
    "director_enriched": sql(
        "select * replace (round(director_votes_log, 9) as director_votes_log) from enriched"),
    "feature_matrix": sql(f"select {columns(V.ID_COLUMNS + V.BASE_FEATURES)} from features"),
    "interaction_features": sql("select " + columns(
        ["tconst", *V.POPULARITY_FEATURES, *V.GENRE_PAIR_FEATURES]) + " from matrix"),
    "equal_width_bins": sql(f"select tconst, {FITTED_BIN} as bin from features, vote_range"),
    "training_matrix": MATRIX_SQL,
    "training_matrix_one_pass": MATRIX_SQL,
    "train_test_split": SPLIT_SQL,
    "reliable_subset": sql(
        "select tconst, target_rating, split from features join split using (tconst) "
        "where round(exp(votes_log)) >= 50000"),
    "sample_n": sql(f"select tconst, primarytitle from cleaned {SAMPLE_ORDER}"),
    "source_tsv": sql(
        "select * replace (cast(tconst as varchar) as tconst) from cleaned"),
    "sink_cleaned_by_decade": CLEANED_SQL,
    "model_uncertainty": bootstrap_sql(),
    "title_search_index": sql("""select tconst, primarytitle, text from titles,
      (select unnest(['le 142', 'Title', '42', 'Nowhere', 'Title 7']) as text) where contains(primarytitle, text)"""),
    "genre_tokens": GENRE_TOKENS,
    "genre_token_flags": sql(f"select tconst, {FLAG_LIST} from features"),
    "rollup_health": sql(f"""select count(*) as total_records, round(avg(averagerating), 3) as mean_rating,
      count(distinct decade) as decades_covered, cast(sum(is_high_rated) as bigint) as high_rated_count from cleaned"""),
    "rollup_distinct": sql("""select decade, count(distinct tconst) as titles, count(distinct genres) as genres,
      true as near from cleaned group by decade"""),
    "source_refused": sql("""select reason, count(*) as lines from (select unnest(case
        when tconst % 19 = 0 then ['8 fields, not 9'] when tconst % 221 = 0
        then ['startyear is no int', 'runtimeminutes is no int'] when tconst % 13 = 0 then ['startyear is no int']
        when tconst % 17 = 0 then ['runtimeminutes is no int'] else ['sound'] end) as reason from titles)
      group by reason"""),
    "source_refused_lines": sql("""select count(*) as lines, count(*) filter (bad = 0) as sound,
      count(*) filter (bad = 1) as refused from (select cast(tconst % 19 = 0 or tconst % 13 = 0 or tconst % 17 = 0
        as integer) as bad from titles)"""),
    "sink_features": sql(f"select {columns(V.ID_COLUMNS + V.BASE_FEATURES)} from features"),
    "sink_split": SPLIT_SQL,
    "source_merged_schemas": sql("""select tconst,
      case split when 'train' then 'wide' else 'narrow' end as part,
      case split when 'train' then long_drama end as long_drama,
      case split when 'train' then popularity_score end as popularity_score
      from matrix join split using (tconst)"""),
    "sink_training_csv": sql("select " + ", ".join(
        f"cast({f'cast({c} as varchar)' if c in FLOATS else c} as double) as {c}"
        for c in ["target_rating", *V.FULL_FEATURES])
        + f" from (select {columns(MATRIX_COLUMNS)} from matrix)"),
    "sink_sample_csv": sql(f"""select *, case tconst % 7 when 0 then '  lead' when 1 then 'trail  '
      when 2 then '' when 3 then 'line' || chr(10) || 'break' when 4 then 'a "quote", a comma'
      when 5 then 'back' || chr(92) || 'slash' end as note from cleaned {SAMPLE_ORDER}"""),
    "sink_metrics_json": REGRESSION_SQL,
    "regression_metrics": REGRESSION_SQL,
    "feature_audit": sql(f"""select (select count(*) from features) as row_count,
      unnest([{", ".join(f"'{c}'" for c in V.FULL_FEATURES if c not in V.BASE_FEATURES)}]) as missing"""),
    "add_if_absent": sql("""select tconst, -1.0::double as popularity_score, long_drama,
      votes_log_binned from matrix"""),
    "model_fit": sql(FITS + " where version = 'v4-full'"),
    "model_fit_v1": sql(FITS + " where version = 'v1'"),
    "model_fit_v2": sql(FITS + " where version = 'v2'"),
    "model_fit_v3": sql(FITS + " where version = 'v3'"),
    "model_fit_v4_filtered": sql(FITS + " where version = 'v4-filtered'"),
    "model_history": sql(FITS),
    "model_best": sql("select 'all' as population, 3::bigint as versions, true as is_best"),
    "model_record": sql("select 43 as n_features, true as agrees"),
    "model_importance": sql(
        "select 43::bigint as n_features, 1.0::double as total, 10 as n_top, true as ordered"),
    "model_curve": sql("select cast(unnest(range(1, 501)) as integer) as round, true as sound"),
    "model_predictions": sql(PREDICTED),
    "model_sample": sql(PREDICTED + " order by md5('42:' || tconst), tconst limit 8"),
    "model_stump": sql(STUMP),
    "model_one_tree": trees_sql(V.PLAIN_FEATURES, 1, 3, 1.0, 0.0, 1.0, 1, 0.01),
    "model_two_trees": trees_sql(V.PLAIN_FEATURES, 2, 3, 0.5, 2.5, 1.0, 5, 0.1),
    "model_reloaded": sql("""select count(*) as test_rows, 0::bigint as differing_rows
      from split where split = 'test'"""),
    "score_features": request_features("training"),
    "score_features_service": request_features("service"),
    "score_features_client": request_features("client"),
    "score_rejects": sql(f"""select *, '{{"error":"' || error || '"}}' as response from (
      select request_id, {refused(1)} as error, {refused(2)} as status_code from requests)
      where error is not null"""),
    "score_requests": sql(
        "select request_id, genres, year, actual, true as agrees from requests where genres is not null"),
    "score_client": sql("""select request_id, p as predicted_rating, p >= 7 as is_high_rated,
      case when p < 5 then 'poor' when p < 7 then 'average' when p < 8 then 'good'
           else 'excellent' end as confidence_tier
      from (select request_id, round(a * 1.25 - 1.5 + case when v >= 10000 then 0.5 else 0 end, 2) as p
            from filled_client)"""),
    "score_error": SCORED_SQL,
    "score_error_stream": SCORED_SQL,
    "score_requests_stream": sql(
        "select count(*) as requests, 0::bigint as differing_rows from filled"),
    "score_json": sql(f"""select request_id, 200 as status_code, case when decimal then
        '{{"predicted_rating":6.0,"is_high_rated":false,"confidence_tier":"average","input":'
          || {DECIMAL_TEXT} || '}}'
      else '{{"predicted_rating":' || predicted_rating || ',"is_high_rated":' || is_high_rated
        || ',"confidence_tier":"' || confidence_tier || '","input":' || {PLAIN_TEXT} || '}}'
      end as response
      from (select r.*, request_id % 61 = 0 as decimal, {refused(1)} as error from requests r)
        left join (select request_id, predicted_rating, is_high_rated, confidence_tier from scored)
        using (request_id)
      where error is null"""),
    "metric_sum_5m": sql(METRIC_SUMS),
    "metric_sum_5m_stream": sql(METRIC_SUMS),
    "metric_sum_5m_batches": sql(METRIC_SUMS),
    "metric_avg_5m": sql("""select window_start, job, round(avg(value), 6) as avg_elapsed
      from metrics group by all"""),
    "metric_avg_daily": sql("""select day_start as window_start,
      round(avg(value), 6) as avg_elapsed from metrics group by all"""),
    "metric_alarms": ALARMS_SQL,
    "metric_alarms_stream": ALARMS_SQL,
    "metric_sum_5m_once": sql(METRIC_SUMS),
    "metric_alarm_transitions": TRANSITIONS_SQL,
    "metric_alarm_transitions_stream": TRANSITIONS_SQL,
    "score_directors": DIRECTED,
    "score_directors_stream": DIRECTED,
    "director_before": DIRECTORS_BEFORE,
    "director_of_others": DIRECTORS_OF_OTHERS,
}
# other ways to the same rows
ORACLE |= {
    "sink_daily": CLEANED_SQL,
    "etl_clean_bucketed": CLEANED_SQL,
    "director_stats_bucketed": ORACLE["director_stats"],
    "training_matrix_bucketed": ORACLE["training_matrix"],
    "rollup_decade_stats": ORACLE["v_decade_stats"],
    "rollup_movies_per_decade": ORACLE["rpt_movies_per_decade"],
    "rollup_daily": ORACLE["metric_avg_daily"],
}
