"""SQL (DuckDB) that must give the same rows as the query of the same name.

Means and percentages are written with double literals, since plain decimal
literals would make the engine compute in decimals.
"""

from __future__ import annotations

from itertools import combinations, permutations

# Bronze and silver views over the test tables. Unused ones cost nothing.
VIEWS = r"""
with movies_raw as (
  select * exclude (copies, i) from (
    select *, unnest(range(copies)) as i from (
      select p_partkey as movieId,
             case when p_partkey % 200 = 199 then null else '  ' || p_name || ' ' end as title,
             case when p_brand = 'Brand#1' then '(no genres listed)'
                  else ' ' || replace(p_name, ' ', '|') || '|' || p_type end as genres,
             1 + cast(p_partkey % 100 = 0 as int) as copies
      from part))
),
movies_titled as (
  select movieId, rtrim(title) || case when movieId % 11 = 5 then ', the "Big" One' else '' end
         || case when movieId % 7 = 3 then ' (' || (1900 + movieId % 50) || ')' else '' end
         || ' ' as title, genres
  from movies_raw
),
ratings_raw as (
  select * exclude (copies, i) from (
    select *, unnest(range(copies)) as i from (
      select nullif(l_suppkey, 7) as userId, l_partkey as movieId,
             cast(l_quantity as double) / 10 as rating,
             cast(floor(epoch(l_shipdate)) as bigint) + 3600 * l_linenumber
               + 86400 * (l_orderkey % 28) as "timestamp",
             1 + cast(l_orderkey % 50 = 0 as int) as copies
      from lineitem))
),
tags_raw as (
  select * exclude (copies, i) from (
    select *, unnest(range(copies)) as i from (
      select nullif(user_id, 3) as userId, event_id % 2000 as movieId,
             ' ' || event_type || '  ' as tag,
             cast(floor(epoch(ts)) as bigint) as "timestamp",
             1 + cast(event_id % 40 = 0 as int) as copies
      from events))
),
links_raw as (
  select * exclude (copies, i) from (
    select *, unnest(range(copies)) as i from (
      select p_partkey as movieId,
             case when p_partkey % 100 = 99 then null
                  else lpad(cast(p_partkey as varchar), 7, '0') end as imdbId,
             case when p_partkey % 9 = 0 then null
                  else cast(p_partkey % 1500 as varchar) end as tmdbId,
             1 + cast(p_partkey % 100 = 0 as int) as copies
      from part))
),
movies as (
  select distinct movieId, trim(title) as title, trim(genres) as genres
  from movies_raw where movieId is not null and title is not null
),
ratings_once as (
  select userId, movieId, min(rating) as rating, "timestamp"
  from ratings_raw group by userId, movieId, "timestamp"
),
ratings as (
  select userId, movieId, rating, ts as "timestamp",
         cast(year(ts) as integer) as "year", cast(month(ts) as integer) as "month",
         cast(day(ts) as integer) as "day", cast(dayofweek(ts) + 1 as integer) as dayOfWeek,
         cast(hour(ts) as integer) as "hour"
  from (select *, make_timestamp("timestamp" * 1000000) as ts from ratings_once)
  where userId is not null and movieId is not null and rating between 0.5 and 5.0
),
tags as (
  select distinct userId, movieId, trim(tag) as tag,
         make_timestamp("timestamp" * 1000000) as "timestamp"
  from tags_raw where userId is not null and movieId is not null and tag is not null
),
links as (
  select distinct movieId, imdbId, tmdbId
  from links_raw where movieId is not null and imdbId is not null
),
movie_genre as (
  select * from (select movieId, title, unnest(string_split(genres, '|')) as genre from movies)
  where genre <> '(no genres listed)'
),
stats_exact as (
  select movieId, avg(rating) as mean, count(rating) as num_votes from ratings group by movieId
),
stats as (
  select movieId, round(mean, 6) as avg_rating, num_votes from stats_exact
),
genre_candidates as (
  select s.movieId, s.avg_rating, s.num_votes, g.title, g.genre
  from stats s left join movie_genre g on s.movieId = g.movieId
  where s.num_votes >= 5
),
genre_ranked as (
  select *, row_number() over (
    partition by genre order by avg_rating desc, num_votes desc, movieId) as "rank"
  from genre_candidates
),
documents_labelled as (
  select d.doc_id, d.text, d.lang, d.source, d.n_chars, l.quality, l.toxic
  from documents d left join labels l on d.doc_id = l.doc_id
)
"""

_GENRE_MEANS = """
  select g.genre, round(avg(s.mean), 6) as avg_rating_by_genre, count(s.movieId) as num_films
  from stats_exact s {join} join movie_genre g on s.movieId = g.movieId
  group by g.genre
"""

_READBACK = """
  select '{table}' as "table", count(*) as n_written, count(*) as n_read, true as matches
  from {rows}
"""

_CONTENT = """
  select '{table}' as "table", count(*) as n_written, count(*) as n_read, true as same_rows, true as same_content
  from {table}
"""

_FAULTY = "movieId % 97 = 5 or userId is not null and movieId % 89 = 7"

_PARSED_RATINGS = f"""
  (select * from (select userId, movieId, "timestamp", min(rating) as rating from ratings_raw where not ({_FAULTY}) group by all)
   where userId is not null and movieId is not null and rating between 0.5 and 5.0)
"""

_REPORT_WITH_REJECTS = f"""
  select t."table", n_before, n_unparsed, n_after, n_before - n_unparsed - n_after as n_removed,
         round(n_unparsed * 100e0 / n_before, 1) as pct_unparsed,
         round((n_before - n_unparsed - n_after) * 100e0 / n_before, 1) as pct_removed
  from (
    select coalesce("table", 'total') as "table", cast(sum(b) as bigint) as n_before, cast(sum(u) as bigint) as n_unparsed,
           cast(sum(a) as bigint) as n_after
    from (
      select 'movies' as "table", (select count(*) from movies_raw) as b, 0 as u, (select count(*) from movies) as a
      union all select 'ratings', (select count(*) from ratings_raw), (select count(*) from ratings_raw where {_FAULTY}),
                       (select count(*) from {_PARSED_RATINGS})
      union all select 'tags', (select count(*) from tags_raw), 0, (select count(*) from tags)
      union all select 'links', (select count(*) from links_raw), 0, (select count(*) from links))
    group by rollup ("table")) t
"""


def _typed(column: str, value: str, p: float) -> str:
    at = f"{p} * (len(v) - 1)"
    share = f"cast(round({at} - floor({at}), 6) as decimal(7, 6))"
    low, high = f"v[1 + cast(floor({at}) as bigint)]", f"v[1 + cast(ceil({at}) as bigint)]"
    between = f"cast({low} as hugeint) * 1000000 + cast({high} - {low} as hugeint) * cast({share} * 1000000 as bigint)"
    return f"""
      select '{column}' as "column", cast({p} as double) as p, cast({low} as varchar) as lower, cast({high} as varchar) as upper,
             regexp_replace(cast(cast(({between}) // 1000000 as bigint) as varchar) || '.' || lpad(cast(({between}) % 1000000 as varchar), 6, '0'),
                            '\\.?0+$', '') as quantile
      from (select list({value} order by {value}) as v from ratings_raw where {value} is not null)"""


def _correlation(a: str, b: str) -> str:
    return f"""
      select '{a}' as column_a, '{b}' as column_b, count(*) filter ("{a}" is not null and "{b}" is not null) as n,
             round(corr("{a}", "{b}"), 6) as correlation from ratings"""


def _ratio(label: str, number: str) -> str:
    return f"""
      select '{label}' as "label", '{number}' as "number", cast(sum(n) as bigint) as n, round(sqrt(sum(n * (m - c) ** 2) / any_value(s)), 6) as ratio
      from (select "{label}", count(*) as n, avg("{number}") as m from ratings where "{label}" is not null and "{number}" is not null group by 1),
           (select avg("{number}") as c, var_pop("{number}") * count(*) as s from ratings where "{label}" is not null and "{number}" is not null)"""


def _uncertainty(known: str, told: str) -> str:
    return f"""
      select '{known}' as known, '{told}' as told, n, round((hk + ht - hb) / ht, 6) as uncertainty
      from (select cast(sum(c) as bigint) as n, ln(sum(c)) - sum(c * ln(c)) / sum(c) as hb from (select count(*) as c from ratings group by "{known}", "{told}")),
           (select ln(sum(c)) - sum(c * ln(c)) / sum(c) as hk from (select count(*) as c from ratings group by "{known}")),
           (select ln(sum(c)) - sum(c * ln(c)) / sum(c) as ht from (select count(*) as c from ratings group by "{told}"))"""


_BEST = """
  select s.movieId, m.title, s.avg_rating, s.num_votes
  from stats s left join movies m on s.movieId = m.movieId
  where s.num_votes >= 30
  order by s.avg_rating desc, s.num_votes desc, s.movieId limit 10
"""

_REPORT = """
  select t."table", n_before, n_after, n_before - n_after as n_removed,
         round((n_before - n_after) * 100e0 / n_before, 1) as pct_removed
  from (
    select coalesce("table", 'total') as "table", cast(sum(b) as bigint) as n_before,
           cast(sum(a) as bigint) as n_after
    from (
      select 'movies' as "table", (select count(*) from movies_raw) as b,
             (select count(*) from movies) as a
      union all select 'ratings', (select count(*) from ratings_raw), (select count(*) from ratings)
      union all select 'tags', (select count(*) from tags_raw), (select count(*) from tags)
      union all select 'links', (select count(*) from links_raw), (select count(*) from links))
    group by rollup ("table")) t
"""


def _joined(parts: list[str]) -> str:
    return "\nunion all\n".join(parts)


def _summary(
    rows: str, columns: list[str], digits: int, quartiles: bool = False, whole: tuple[str, ...] = ()
) -> str:
    def one(column: str) -> str:
        value = f'cast("{column}" as double)'
        quantiles = "".join(
            f", round(quantile_cont({value}, {p}), {digits}) as {name}"
            for p, name in ((0.25, "q25"), (0.5, "q50"), (0.75, "q75"))
        )
        return (
            f"""select '{column}' as "column", count("{column}") as "count",
            round(avg({value}), {digits}) as mean,
            round(stddev_samp({value}), {digits}) as stddev,
            min({value}) as "min", max({value}) as "max" """
            + (quantiles if quartiles else "".join(
                f', cast({f"{bound}({column})" if column in whole else "null"} as varchar) as {bound}_text'
                for bound in ("min", "max")
            ))
            + f" from {rows}"
        )

    return _joined([one(c) for c in columns])


def _missing(rows: str, types: dict[str, str], table: str | None = None) -> str:
    label = "" if table is None else f"'{table}' as \"table\", "
    return _joined(
        [
            f"""select {label}'{column}' as "column", '{kind}' as "type",
            count(*) - count("{column}") as n_missing,
            round((count(*) - count("{column}")) * 100e0 / count(*), 2) as pct_missing
            from {rows}"""
            for column, kind in types.items()
        ]
    )


def _duplicates(table: str, columns: list[str]) -> str:
    return _joined(
        [
            f"""select '{table}' as "table", '{column}' as "column",
            count(*) filter (n > 1) as n_repeated_values,
            cast(coalesce(sum(n - 1) filter (n > 1), 0) as bigint) as n_extra_rows
            from (select "{column}", count(*) as n from {table}
                  where "{column}" is not null group by "{column}")"""
            for column in columns
        ]
    )


def _top_values(rows: str, columns: dict[str, bool], k: int) -> str:
    def one(column: str, numeric: bool) -> str:
        low, high = f'min("{column}")', f'max("{column}")'
        number = (f"cast({low} as double)", f"cast({high} as double)")
        nothing = ("cast(null as double)", "cast(null as double)")
        lo_n, hi_n = number if numeric else nothing
        lo_t, hi_t = f"cast({low} as varchar)", f"cast({high} as varchar)"
        return f"""
        select * from
          (select '{column}' as "column", count(*) - count("{column}") as n_missing,
                  count(distinct "{column}") as n_distinct, {lo_n} as min_number,
                  {hi_n} as max_number, {lo_t} as min_text, {hi_t} as max_text from {rows}),
          (select cast(row_number() over (order by n desc, "value") as integer) as "rank",
                  "value", n
           from (select cast("{column}" as varchar) as "value", count(*) as n from {rows}
                 where "{column}" is not null group by 1)
           order by "rank" limit {k})"""

    return _joined([f"select * from ({one(c, numeric)})" for c, numeric in columns.items()])


_GOLD = (
    ("movieId", "title", "avg_rating", "num_votes"),
    ("genre", "avg_rating_by_genre", "num_films"),
    ("genre", "rank", "title", "avg_rating", "num_votes"),
)


def _cells(table: str, rows: str, key: str, columns: tuple[str, ...]) -> str:
    return _joined(
        [
            f"""select '{table}' as "table", {key} as "row", '{c}' as "column",
            cast("{c}" as varchar) as "value" from ({rows})"""
            for c in columns
        ]
    )


def _score(table: str, columns: list[str], key: list[str], ranged: str | None) -> str:
    filled = " + ".join(f'count("{c}")' for c in columns)
    keys = ", ".join(f'"{c}"' for c in key)
    valid = (
        "100e0"
        if ranged is None
        else f"round(count(*) filter ({ranged} between 0.5 and 5.0) * 100e0 / count({ranged}), 2)"
    )
    coherent = (
        "100e0"
        if table == "movies"
        else "round(count(*) filter (movieId in (select movieId from movies_raw)) * 100e0 / count(movieId), 2)"
    )
    return f"""
    select '{table}' as "table", count(*) as n_rows, {coherent} as pct_coherent,
           round(({filled}) * 100e0 / (count(*) * {len(columns)}), 2) as pct_complete,
           round((select count(*) from (select distinct {keys} from {table}_raw))
                 * 100e0 / count(*), 2) as pct_unique,
           {valid} as pct_valid
    from {table}_raw"""


_BRONZE = {
    "movies": {"movieId": "bigint", "title": "string", "genres": "string"},
    "ratings": {
        "userId": "bigint", "movieId": "bigint", "rating": "double", "timestamp": "bigint"
    },
    "tags": {"userId": "bigint", "movieId": "bigint", "tag": "string", "timestamp": "bigint"},
    "links": {"movieId": "bigint", "imdbId": "string", "tmdbId": "string"},
}

_KEYS = {
    "movies": ["movieId"],
    "ratings": ["userId", "movieId", "timestamp"],
    "tags": ["userId", "movieId", "tag", "timestamp"],
    "links": ["movieId"],
}

_SELECTS: dict[str, str] = {
    "scan_csv_schema": "select * from movies_titled",
    "scan_csv_ratings": "select * from ratings_raw",
    "scan_csv_tags": "select * from tags_raw",
    "scan_csv_links": "select * from links_raw",
    "scan_csv_infer": """
      select userId, movieId, rating, ts as "timestamp", cast(year(ts) as integer) as "year"
      from (select * exclude ("timestamp"), make_timestamp("timestamp" * 1000000) as ts
            from ratings_raw)""",
    "scan_csv_rejects": f"""
      select coalesce(case when movieId % 89 = 7 then 'u' || userId else cast(userId as varchar) end, '') || ',' || movieId || ','
             || case when movieId % 97 = 5 then 'four' else cast(rating as varchar) end || ',' || "timestamp" as line
      from ratings_raw where {_FAULTY}""",
    "scan_parquet": "select p_partkey, p_name, p_brand, p_type from part",
    "scan_partitioned": 'select * from ratings where "year" = 1998',
    "sink_parquet_roundtrip": "select * from movies",
    "sink_partitioned_roundtrip": "select * from ratings",
    "sink_partitioned_in_place": "select * from ratings",
    "sink_csv_roundtrip": _BEST,
    "preview_first_n": "select * from movies order by movieId limit 10",
    "schema_report": _joined(
        [
            f"""select '{table}' as "table", {position} as "position", '{column}' as "column",
            '{kind}' as "type", true as nullable, count(*) > count("{column}") as has_nulls
            from {table}_raw"""
            for table, columns in _BRONZE.items()
            for position, (column, kind) in enumerate(columns.items(), start=1)
        ]
    ),
    "verify_content": _joined([_CONTENT.format(table=t) for t in ("movies", "ratings", "tags", "links")]),
    "verify_readback": _joined(
        [_READBACK.format(table=t, rows=t) for t in ("movies", "ratings", "tags", "links")]
    ),
    "project_columns": 'select userId, movieId, rating, "year", "month" from ratings',
    "explode_genres": "select * from movie_genre",
    "calendar_columns": """
      select ts as "timestamp", cast(year(ts) as integer) as "year",
             cast(month(ts) as integer) as "month", cast(day(ts) as integer) as "day",
             cast(dayofweek(ts) + 1 as integer) as dayOfWeek, cast(hour(ts) as integer) as "hour"
      from (select distinct make_timestamp("timestamp" * 1000000) as ts from tags_raw)""",
    "filter_range": """
      select rating, count(*) as n from ratings_raw
      where rating between 0.5 and 4.5 group by rating""",
    "count_year": """
      select 'ratings' as "table", count(*) as n_rows from ratings where "year" = 1998""",
    "count_high_ratings": """
      select 'ratings' as "table", count(*) as n_rows from ratings where rating >= 4""",
    "having_min_votes": "select * from stats where num_votes >= 30",
    "filter_sentinel": "select * from movie_genre",
    "count_null_optional": """
      select count(*) as n_rows, count(*) - count(tmdbId) as n_null,
             round((count(*) - count(tmdbId)) * 100e0 / count(*), 1) as pct_null from links""",
    "drop_null_keys": "select * from links_raw where movieId is not null and imdbId is not null",
    "links_strict": "select * from links where tmdbId is not null",
    "dedup_by_key": "select * from ratings_once",
    "dedup_by_key_wide": """
      select o_custkey, o_orderstatus, priority, order_id from (
        select *, row_number() over (
          partition by o_custkey, o_orderstatus
          order by priority nulls last, order_id) as i
        from (select o_custkey, o_orderstatus, o_orderkey as order_id,
                     case when o_orderkey % 3 <> 0 then o_orderpriority end as priority
              from orders))
      where i = 1""",
    "distinct_genres": "select distinct genre from movie_genre",
    "count_distinct_users": """
      select count(*) as n_values, count(userId) as n_non_null
      from (select distinct userId from ratings_raw)""",
    "left_join_titles": """
      select s.*, m.title from stats s left join movies m on s.movieId = m.movieId""",
    "inner_join_titles": """
      select s.*, m.title from stats s join movies m on s.movieId = m.movieId""",
    "broadcast_join_genres": "select * from genre_candidates",
    "orphan_ratings": """
      select movieId, count(*) as n_rows from ratings anti join movies using (movieId)
      group by movieId""",
    "orphan_tags": """
      select movieId, count(*) as n_rows from tags anti join movies using (movieId)
      group by movieId""",
    "catalog_coverage": """
      select n_total, n_covered, round(n_covered * 100e0 / n_total, 2) as pct_covered
      from (select (select count(*) from movies) as n_total,
                   (select count(*) from movies
                    where movieId in (select movieId from ratings))
                     as n_covered)""",
    "eligible_movies": """
      select count(*) as n_movies, count(*) filter (num_votes >= 30) as n_eligible from stats""",
    "genre_counts": """
      select count(*) as n_with_null, count(genre) as n_genres from (
        select distinct genre from (
          select unnest(case when len(g) = 0 then [null] else g end) as genre
          from (select coalesce(list_filter(string_split(genres, '|'),
                                            lambda x: x <> '(no genres listed)'), []) as g
                from movies)))""",
    "sink_files": "select count(*) as n_rows, cast(3 as bigint) as n_files from movies",
    "row_counts": _joined(
        [f"""select '{t}' as "table", count(*) as n_rows from {t}_raw""" for t in _BRONZE]
    ),
    "movie_stats": "select * from stats",
    "genre_mean_of_means": _GENRE_MEANS.format(join="inner"),
    "global_min_max": """
      select min(userId) as min_userId, max(userId) as max_userId, min(movieId) as min_movieId,
             max(movieId) as max_movieId, min(rating) as min_rating, max(rating) as max_rating,
             min("timestamp") as min_timestamp, max("timestamp") as max_timestamp
      from ratings_raw""",
    "ratings_per_year": 'select "year", count(*) as n from ratings group by "year"',
    "rating_histogram": "select rating, count(*) as n from ratings group by rating",
    "describe_numeric": _summary(
        "ratings_raw", ["userId", "movieId", "rating", "timestamp"], digits=3,
        whole=("userId", "movieId", "timestamp"),
    ),
    "dataset_facts": """
      select 'movies' as fact, count(*) as "value" from movies
      union all select 'ratings', count(*) from ratings
      union all select 'users', count(distinct userId) from ratings
      union all select 'first_year', cast(min("year") as bigint) from ratings
      union all select 'last_year', cast(max("year") as bigint) from ratings""",
    "row_number_genre": """
      select movieId, avg_rating, num_votes, title, genre, "rank" from genre_ranked""",
    "topn_per_genre": """
      select movieId, avg_rating, num_votes, title, genre, cast("rank" as integer) as "rank"
      from genre_ranked where "rank" <= 3 and genre is not null""",
    "topk_movies": """
      select * from stats order by avg_rating desc, num_votes desc, movieId limit 10""",
    "trim_text": "select movieId, trim(title) as title, trim(genres) as genres from movies_raw",
    "split_list": """
      select movieId, len(items) as n_items, items[1] as first_item, items[-1] as last_item
      from (select movieId, string_split(genres, '|') as items from movies)""",
    "epoch_to_timestamp": """
      select userId, movieId, tag, make_timestamp("timestamp" * 1000000) as "timestamp"
      from tags_raw""",
    "normalize_tags": """
      select distinct userId, movieId, lower(tag) as tag, "timestamp"
      from (select * from tags union all
            select userId, movieId, upper(tag), "timestamp" from tags where movieId % 40 = 20)""",
    "cached_filter_count": _joined(
        [
            f"""select '{run}' as run, count(*) as n_rows from ratings where "year" = 1998"""
            for run in ("uncached", "filling", "warm")
        ]
    ),
    "cached_query_batch": """
      select 'one_year' as query, '1998' as bucket, count(*) as n
      from ratings where "year" = 1998
      union all
      select 'high_ratings', '4.0', count(*) from ratings where rating >= 4
      union all
      select 'by_year', cast("year" as varchar), count(*) from ratings group by "year"
      union all
      select 'by_rating', cast(rating as varchar), count(*) from ratings group by rating""",
    "strategy_equivalence": f"""
      select count(*) as n_left, count(*) as n_right, cast(0 as bigint) as n_different
      from ({_GENRE_MEANS.format(join="left")})""",
    "profile_shape": """
      select count(*) as n_rows, cast(4 as bigint) as n_columns from ratings_raw""",
    "preview_last_n": "select * from movies order by movieId desc limit 5",
    "sample_n": """
      select * from movies order by md5('42:' || cast(movieId as varchar)), movieId limit 5""",
    "profile_missing": _missing(
        "documents_labelled",
        {
            "doc_id": "bigint", "text": "string", "lang": "string", "source": "string",
            "n_chars": "bigint", "quality": "int", "toxic": "int",
        },
    ),
    "profile_quartiles": _summary(
        "ratings_raw", ["userId", "movieId", "rating"], digits=4, quartiles=True
    ),
    "profile_typed_quartiles": _joined(
        [
            _typed(column, value, p)
            for column, value in (("movieId", "movieId"), ("far", '("timestamp" * 9000000000 + movieId)'))
            for p in (0.25, 0.5, 0.75)
        ]
    ),
    "profile_correlations": _joined([_correlation(a, b) for a, b in combinations(("userId", "movieId", "rating", "month", "hour"), 2)]),
    "profile_correlation_ratios": _joined([_ratio(a, b) for a in ("year", "dayOfWeek") for b in ("rating", "hour")]),
    "profile_uncertainties": _joined([_uncertainty(a, b) for a, b in permutations(("year", "month", "rating"), 2)]),
    "profile_text_lengths": _summary(
        "documents_labelled", ["n_chars", "quality"], digits=4, quartiles=True
    ),
    "profile_all_tables": _joined([_missing(f"{t}_raw", c, t) for t, c in _BRONZE.items()]),
    "profile_duplicates": _joined(
        [
            _duplicates("movies", ["movieId", "title", "genres"]),
            _duplicates("links", ["movieId", "imdbId", "tmdbId"]),
            _duplicates("documents", ["doc_id", "text"]),
        ]
    ),
    "profile_top_values": _top_values(
        "tags_raw", {"userId": True, "movieId": True, "tag": False}, k=3
    ),
    "profile_target": """
      select cast(dayOfWeek as varchar) as "value", count(*) as n_rows,
             round(avg(rating), 6) as mean_target
      from ratings group by dayOfWeek""",
    "profile_keys_as_labels": _summary(
        "ratings_raw", ["rating", "timestamp"], digits=3, whole=("timestamp",)
    ),
    "clean_movies": "select * from movies",
    "clean_ratings": "select * from ratings",
    "clean_tags": "select * from tags",
    "clean_links": "select * from links",
    "cleaning_report": _REPORT,
    "cleaning_report_with_rejects": _REPORT_WITH_REJECTS,
    "silver_pipeline": _REPORT,
    "best_movies": _BEST,
    "genre_ratings": _GENRE_MEANS.format(join="left"),
    "top_movies_per_genre": """
      select genre, cast("rank" as integer) as "rank", title, avg_rating, num_votes
      from genre_ranked where "rank" <= 3""",
    "gold_pipeline": _joined(
        [
            _cells("analysis1_best_films", _BEST, "cast(movieId as varchar)", _GOLD[0]),
            _cells(
                "analysis2_avg_by_genre", _GENRE_MEANS.format(join="left"), "coalesce(genre, 'none')", _GOLD[1]
            ),
            _cells(
                "analysis3_top3_by_genre", 'select * from genre_ranked where "rank" <= 3',
                """coalesce(genre, 'none') || '|' || cast("rank" as varchar)""", _GOLD[2],
            ),
        ]
    ),
    "validate_ratings": """
      select min(rating) as min_rating, max(rating) as max_rating,
             min("year") as min_year, max("year") as max_year from ratings""",
    "mean_ratings_per_user": """
      select count(*) as n_keys, round(avg(n), 2) as mean_rows
      from (select userId, count(*) as n from ratings group by userId)""",
    "count_distinct_tags": """
      select count(*) as n_values, count(tag) as n_non_null from (select distinct tag from tags)""",
    "off_scale_ratings": """
      select count(*) as n_rows, count(*) filter (rating * 2 <> floor(rating * 2)) as n_off_scale,
             round(count(*) filter (rating * 2 <> floor(rating * 2)) * 100e0 / count(*), 2)
               as pct_off_scale
      from ratings""",
    "titles_with_year": r"""
      select count(title) as n_titles,
             count(*) filter (regexp_matches(title, '\(\d{4}\)\s*$')) as n_with_year,
             round(count(*) filter (regexp_matches(title, '\(\d{4}\)\s*$')) * 100e0
                   / count(title), 2) as pct_with_year
      from (select distinct movieId, trim(title) as title from movies_titled
            where movieId is not null and title is not null)""",
    "activity_by_weekday_hour": """
      select dayOfWeek, "hour", count(*) as n from ratings group by dayOfWeek, "hour" """,
    "tag_frequencies": "select tag, count(*) as n from tags group by tag",
    "quality_scorecard": _joined(
        [
            _score(t, list(c), _KEYS[t], "rating" if t == "ratings" else None)
            for t, c in _BRONZE.items()
        ]
    ),
}


def oracle_sql() -> dict[str, str]:
    return {name: f"{VIEWS}\n{select}" for name, select in _SELECTS.items()}
