"""Cleaning and reports on random, dirty tables against plain Python."""

import random
from collections import Counter, defaultdict
from datetime import UTC, datetime

import pytest

import __spark_entry__ as entry_points
from cinetally.operators import checks, cleaning, profiling
from cinetally.plans import reports
from cinetally.schemas import LINKS, MOVIES, NO_GENRE, RATINGS, TAGS


def pick(draw, *values):
    return draw.choice(values)


@pytest.fixture(scope="module", params=[1, 2, 3])
def dirty(request):
    """Few keys, so duplicates and conflicts abound; one movie gets a third of the ratings."""
    draw = random.Random(request.param)
    movies = [
        (
            pick(draw, None, *range(12)),
            pick(draw, None, " a", "a ", "b", "\tc"),
            pick(draw, None, NO_GENRE, "x|y", " x|z ", "y||y", "", f"x|{NO_GENRE}"),
        )
        for _ in range(60)
    ]
    ratings = [
        (
            pick(draw, None, 1, 2, 3, 4),
            pick(draw, None, *[1] * 6, *range(12)),
            pick(draw, None, 0.0, 0.5, 1.0, 2.5, 4.0, 5.0, 5.5),
            pick(draw, None, 0, 86399, 86400, 964982703, 1230768000),
        )
        for _ in range(900)
    ]
    tags = [
        (
            pick(draw, None, 1, 2), pick(draw, None, 1, 2),
            pick(draw, None, " t", "t ", "T", "\t"), pick(draw, None, 5, 6),
        )
        for _ in range(200)
    ]
    links = [
        (pick(draw, None, *range(8)), pick(draw, None, "01", "02"), pick(draw, None, "7", "8"))
        for _ in range(60)
    ]
    return movies, ratings, tags, links


def survivors(rows, key_size):
    """Smallest payload per key, None after everything else."""
    best = {}
    for row in rows:
        key, payload = row[:key_size], row[key_size:]
        rank = tuple((v is None, "" if v is None else v) for v in payload)
        if key not in best or rank < best[key][0]:
            best[key] = (rank, payload)
    return [key + payload for key, (_, payload) in best.items()]


def strip(text):
    return None if text is None else text.strip(" ")


def clean_movies(rows):
    return [
        (m, strip(t), strip(g))
        for m, t, g in survivors(rows, 1)
        if m is not None and t is not None
    ]


def clean_ratings(rows):
    by_key = survivors([(u, m, ts, r) for u, m, r, ts in rows], 3)
    return [
        (u, m, r, ts)
        for u, m, ts, r in by_key
        if None not in (u, m, r) and 0.5 <= r <= 5.0
    ]


def frame(spark, rows, spec):
    return spark.createDataFrame(rows, spec.schema).repartition(5)


def test_movies_and_links(spark, dirty):
    movies, _, _, links = dirty
    got = cleaning.clean_movies(frame(spark, movies, MOVIES)).collect()
    assert Counter(map(tuple, got)) == Counter(clean_movies(movies))
    kept = [r for r in survivors(links, 1) if r[0] is not None and r[1] is not None]
    got = cleaning.clean_links(frame(spark, links, LINKS)).collect()
    assert Counter(map(tuple, got)) == Counter(kept)


def test_ratings_and_calendar(spark, dirty):
    got = cleaning.clean_ratings(frame(spark, dirty[1], RATINGS)).selectExpr(
        "userId", "movieId", "rating", "unix_timestamp(timestamp)",
        "year", "month", "day", "dayOfWeek", "hour",
    ).collect()

    def with_calendar(row):
        if row[3] is None:
            return row + (None,) * 5
        at = datetime.fromtimestamp(row[3], UTC)
        return row + (at.year, at.month, at.day, at.isoweekday() % 7 + 1, at.hour)

    assert Counter(map(tuple, got)) == Counter(map(with_calendar, clean_ratings(dirty[1])))


def test_tags(spark, dirty):
    got = cleaning.clean_tags(frame(spark, dirty[2], TAGS)).selectExpr(
        "userId", "movieId", "tag", "unix_timestamp(timestamp)"
    ).collect()
    expected = [
        (u, m, strip(t), ts) for u, m, t, ts in set(dirty[2]) if None not in (u, m, t)
    ]
    assert Counter(map(tuple, got)) == Counter(expected)


def stats_of(ratings):
    values = defaultdict(list)
    for _, m, r, _ in ratings:
        values[m].append(r)
    return {m: (sum(v) / len(v), len(v)) for m, v in values.items()}


def genres_of(movies):
    lists = {}
    for m, title, genres in movies:
        tokens = [] if genres is None else genres.split("|")
        lists[m] = [(g, title) for g in tokens if g != NO_GENRE]
    return lists


def test_reports(spark, dirty):
    movies = clean_movies(dirty[0])
    stats = stats_of(clean_ratings(dirty[1]))
    titles = {m: t for m, t, _ in movies}
    genres = genres_of(movies)
    silver_movies = cleaning.clean_movies(frame(spark, dirty[0], MOVIES))
    silver_ratings = cleaning.clean_ratings(frame(spark, dirty[1], RATINGS))

    ranked = sorted(
        ((m, titles.get(m), round(a, 6), n) for m, (a, n) in stats.items() if n >= 3),
        key=lambda r: (-r[2], -r[3], r[0]),
    )
    best = reports.best_movies(silver_ratings, silver_movies, min_votes=3, k=5).collect()
    assert [tuple(r) for r in best] == ranked[:5]

    by_genre = defaultdict(list)
    for m, (mean, votes) in stats.items():
        for genre, title in genres.get(m) or [(None, None)]:
            by_genre[genre].append((mean, votes, m, title))
    means = {
        g: (round(sum(r[0] for r in rows) / len(rows), 6), len(rows))
        for g, rows in by_genre.items()
    }
    got = reports.genre_ratings(silver_ratings, silver_movies).collect()
    assert {r[0]: (r[1], r[2]) for r in got} == means

    expected = []
    for genre, rows in by_genre.items():
        rows.sort(key=lambda r: (-round(r[0], 6), -r[1], r[2]))
        for rank, (mean, votes, _, title) in enumerate(rows[:2], start=1):
            expected.append((genre, rank, title, round(mean, 6), votes))
    top = reports.top_movies_per_genre(silver_ratings, silver_movies, min_votes=1, n=2)
    assert Counter(map(tuple, top.collect())) == Counter(expected)


def test_profiles(spark, dirty):
    df = frame(spark, dirty[1], RATINGS)
    columns = list(zip(*dirty[1]))
    repeats = {}
    for name, values in zip(RATINGS.schema.names, columns):
        counts = Counter(v for v in values if v is not None)
        more = [n for n in counts.values() if n > 1]
        repeats[name] = (len(more), sum(more) - len(more))
    got = profiling.duplicates(df).collect()
    assert {r[0]: (r[1], r[2]) for r in got} == repeats
    missing = {r["column"]: r["n_missing"] for r in profiling.missing_values(df).collect()}
    assert missing == {n: c.count(None) for n, c in zip(RATINGS.schema.names, columns)}

    score = checks.quality_scorecard({"ratings": df}, {"ratings": RATINGS}).first()
    cells = sum(v is not None for c in columns for v in c)
    present = [r[2] for r in dirty[1] if r[2] is not None]
    keys = {(u, m, ts) for u, m, _, ts in dirty[1]}
    assert score["pct_complete"] == pytest.approx(cells / 36, abs=0.006)
    assert score["pct_unique"] == pytest.approx(len(keys) / 9, abs=0.006)
    valid = sum(0.5 <= v <= 5.0 for v in present)
    assert score["pct_valid"] == pytest.approx(100 * valid / len(present), abs=0.006)


def test_entry_returns_the_flagship_report(spark):
    best = entry_points.entry(spark)
    assert best.columns == ["movieId", "title", "avg_rating", "num_votes"]
    assert len(best.collect()) == 10
