"""Profiles and checks on values that are easily confused."""

import hashlib
import warnings

import pytest
from pyspark.sql import functions as F

from cinetally import jobs
from cinetally.operators import aggregates, checks, cleaning, joins, profiling
from cinetally.plans import pipelines, reports
from cinetally.schemas import MOVIES, RATINGS, SPECS, TAGS
from cinetally.sources.readers import read_bronze, read_silver_tables
from cinetally.sources.writers import write_csv, write_parquet
from test_jobs import TABLES

BIG = 2**53


def test_a_text_that_spells_a_digest_is_another_text(spark):
    long = "x" * 100
    digest = hashlib.sha256(long.encode()).hexdigest()
    texts = [long, digest, "#" + digest[:60], "=" + "a", "a"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [tuple(r) for r in profiling.duplicates(df).collect()] == [("t", 0, 0)]


def test_zero_has_one_form(spark):
    df = spark.createDataFrame([(0.0,), (-0.0,)], "x double")
    assert [tuple(r) for r in profiling.duplicates(df).collect()] == [("x", 1, 1)]


def test_an_empty_table_has_a_row_per_column(spark):
    df = spark.createDataFrame([], "`a.b` string, x double")
    assert sorted(tuple(r) for r in profiling.duplicates(df).collect()) == [("a.b", 0, 0), ("x", 0, 0)]
    assert sorted(r["column"] for r in profiling.top_values(df).collect()) == ["a.b", "x"]


def test_dotted_names(spark):
    df = spark.createDataFrame([(1, "u"), (1, "v")], "`a.b` long, `c``d` string")
    assert {tuple(r) for r in profiling.duplicates(df).collect()} == {("a.b", 1, 1), ("c`d", 0, 0)}
    assert profiling.top_values(df, k=1).filter("column = 'a.b'").first()["n"] == 2
    assert aggregates.numeric_summary(df).first()["column"] == "a.b"


def test_whole_numbers_keep_all_digits(spark):
    df = spark.createDataFrame([(BIG,), (BIG + 1,)], "id long")
    top = profiling.top_values(df, k=2).orderBy("rank").collect()
    assert (top[0]["min_text"], top[0]["max_text"]) == (str(BIG), str(BIG + 1))
    assert [r["value"] for r in top] == [str(BIG), str(BIG + 1)]
    summary = aggregates.numeric_summary(df).first()
    assert (summary["min_text"], summary["max_text"]) == (str(BIG), str(BIG + 1))


def test_frequent_long_texts_come_back_whole(spark):
    long = "ab" * 200
    df = spark.createDataFrame([(long,)] * 3 + [("short",)] * 2 + [(None,)], "t string")
    top = profiling.top_values(df, k=2).orderBy("rank").collect()
    assert [(r["value"], r["n"]) for r in top] == [(long, 3), ("short", 2)]


def test_long_texts_are_not_shuffled(spark):
    df = spark.createDataFrame([("x" * 1000,)], "t string")
    counts = profiling.value_counts(df, ["t"], marked=True)
    assert counts.agg(F.max(F.length("value"))).first()[0] == 65
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert plan.index("sha2") > plan.index("Exchange")  # below the exchange


@pytest.mark.parametrize("step", [0.1, 0.25, 0.5])
def test_multiples_of_any_step_are_on_the_scale(spark, step):
    df = spark.range(1, 60).select((F.col("id") * step).alias("rating"))
    assert checks.off_scale(df, step=step).first()["n_off_scale"] == 0
    off = df.withColumn("rating", F.col("rating") + step / 3)
    assert checks.off_scale(off, step=step).first()["n_off_scale"] == 59


def test_folding_merges_rows_that_differ_in_case(spark):
    rows = [(1, 1, "Fun", 5), (1, 1, "fun ", 5), (1, 1, "FUN", 6)]
    df = spark.createDataFrame(rows, TAGS.schema)
    folded = cleaning.clean(df, TAGS, fold_case=True)
    assert sorted((r["tag"], r["timestamp"].timestamp()) for r in folded.collect()) == [("fun", 5.0), ("fun", 6.0)]
    assert cleaning.clean(df, TAGS).count() == 3


def test_doubled_quotes(spark, tmp_path):
    (tmp_path / "movies.csv").write_text('movieId,title,genres\n5,"The ""Big"" One, Part 2 (1997)",Drama\n')
    got = read_bronze(spark, MOVIES, f"{tmp_path}/movies.csv").collect()
    assert [tuple(r) for r in got] == [(5, 'The "Big" One, Part 2 (1997)', "Drama")]
    rows = spark.createDataFrame([(1, 'a "b", c', 'x\\"y'), (2, '"', "\\")], MOVIES.schema)
    write_csv(rows, f"{tmp_path}/again")
    assert sorted(map(tuple, read_bronze(spark, MOVIES, f"{tmp_path}/again").collect())) == sorted(map(tuple, rows.collect()))


def test_schema_comes_from_metadata(spark):
    df = spark.createDataFrame([(None,)], "x int")
    plan = profiling.schema_report(df)._jdf.queryExecution().executedPlan().toString()
    assert "Scan ExistingRDD" not in plan
    assert profiling.schema_report(df, with_nulls=True).first()["has_nulls"]


def test_broadcast_beyond_the_limit_warns(spark):
    left, right = spark.range(3).toDF("k"), spark.range(3).toDF("k")
    with pytest.warns(UserWarning, match="not broadcast"):
        joins.attach(left, right, "k", strategy="broadcast", broadcast_limit=1)
    with warnings.catch_warnings():
        warnings.simplefilter("error")
        assert joins.attach(left, right, "k", strategy="broadcast").count() == 3


def test_files_do_not_gather_the_work(spark, tmp_path):
    df = spark.range(1000).repartition(4)
    assert write_parquet(df, f"{tmp_path}/t", files=2) == 1000
    assert spark.read.parquet(f"{tmp_path}/t").select("_metadata.file_path").distinct().count() == 2
    with pytest.raises(ValueError):
        write_parquet(df, f"{tmp_path}/u", files=2, partition_by=("id",))


def test_calendar_is_made_behind_the_shuffle(spark, tmp_path, monkeypatch):
    seen = {}

    def spy(df, path, **options):
        seen[path.rsplit("/", 1)[1]] = df.columns
        return write_parquet(df, path, **options)

    monkeypatch.setattr(pipelines, "write_parquet", spy)
    rows = spark.createDataFrame([(1, 1, 3.0, 1_000_000_000)], RATINGS.schema)
    pipelines.bronze_to_silver({"ratings": rows}, f"{tmp_path}/silver", {"ratings": RATINGS})
    assert seen["ratings"] == ["userId", "movieId", "rating", "timestamp", "year"]
    stored = read_silver_tables(spark, f"{tmp_path}/silver", {"ratings": RATINGS})["ratings"].first()
    assert (stored["year"], stored["month"], stored["day"]) == (2001, 9, 9)


def test_reports_go_to_a_folder(spark, tmp_path):
    (tmp_path / "bronze").mkdir()
    for name, text in TABLES.items():
        (tmp_path / "bronze" / f"{name}.csv").write_text(text)
    jobs.main(["profile", "--bronze", f"{tmp_path}/bronze", "--out", f"{tmp_path}/out"])
    stored = spark.read.csv(f"{tmp_path}/out/ratings-duplicates", header=True)
    assert {r["column"] for r in stored.collect()} == {"userId", "movieId", "rating", "timestamp"}


def test_counts_beside_the_reports(spark):
    ratings = spark.createDataFrame([(1, 1, 3.0, 1), (2, 1, 3.0, 1), (1, 2, 3.0, 1)], RATINGS.schema)
    assert tuple(reports.eligible_movies(reports.movie_means(ratings), 2).first()) == (2, 1)
    movies = spark.createDataFrame([(1, "a", "X|Y"), (2, "b", "(no genres listed)")], MOVIES.schema)
    assert tuple(reports.genre_counts(movies).first()) == (3, 2)
    score = checks.quality_scorecard({"movies": movies.limit(1), "ratings": ratings}, SPECS).collect()
    assert {r["table"]: r["pct_coherent"] for r in score} == {"movies": 100.0, "ratings": 66.67}
