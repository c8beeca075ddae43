"""Lines that do not parse, counts that ride on one scan, and digests of what was written."""

import pytest
from pyspark.sql import DataFrameWriter, functions as F

from cinetally.operators import cleaning
from cinetally.plans import pipelines
from cinetally.schemas import MOVIES, RATINGS, SPECS
from cinetally.sources.readers import UNPARSED, parsed, read_bronze, rejected
from cinetally.sources.writers import content_digest, verify_content, write_parquet, write_parquet_checked

LINES = """userId,movieId,rating,timestamp
1,10,4.0,964982703
2,10,four,964982703
3,10
4,10,3.5,964982703,more
,10,2.0,964982703
x,,,
5,11,0.1,964982703
5,12,5.0,
"""
BAD = ["2,10,four,964982703", "3,10", "4,10,3.5,964982703,more", "x,,,"]


@pytest.fixture
def faulty(spark, tmp_path):
    (tmp_path / "ratings.csv").write_text(LINES)
    return read_bronze(spark, RATINGS, f"{tmp_path}/ratings.csv", rejects=True)


def test_lines_that_do_not_parse(faulty):
    assert sorted(r.line for r in rejected(faulty).collect()) == sorted(BAD)
    assert rejected(faulty).count() == 4
    assert faulty.filter(F.col(UNPARSED).isNotNull()).count() == 4
    assert sorted((r.userId or 0, r.movieId) for r in parsed(faulty).collect()) == [(0, 10), (1, 10), (5, 11), (5, 12)]
    # What else is asked for makes no difference.
    assert parsed(faulty).select("movieId").count() == 4
    assert parsed(faulty).agg(F.sum("movieId")).first()[0] == 43


def test_rejects_need_the_schema(spark):
    with pytest.raises(ValueError):
        read_bronze(spark, RATINGS, "none", rejects=True, infer=True)
    with pytest.raises(ValueError):
        read_bronze(spark, RATINGS, "none", rejects=True, mode="FAILFAST")


def test_swapped_header_is_refused_with_rejects(spark, tmp_path):
    (tmp_path / "m.csv").write_text("title,movieId,genres\na,1,x\n")
    with pytest.raises(Exception, match="header"):
        read_bronze(spark, MOVIES, f"{tmp_path}/m.csv", rejects=True).collect()


def test_report_keeps_unparsed_apart(spark, faulty, tmp_path):
    runs = pipelines.clean_to_silver({"ratings": faulty}, f"{tmp_path}/silver", SPECS, rejects=f"{tmp_path}/rejects")
    report = {r["table"]: r for r in pipelines.run_report(spark, runs).collect()}
    # Of the four that parse one lacks its user and one is off the scale.
    assert tuple(report["ratings"])[1:] == (8, 4, 2, 2, 50.0, 25.0) == tuple(report["total"])[1:]
    assert sorted(r.value for r in spark.read.text(f"{tmp_path}/rejects/ratings").collect()) == sorted(BAD)
    assert all(r.same_rows and r.same_content for r in pipelines.verify_silver_content(spark, f"{tmp_path}/silver", runs).collect())


def test_a_table_without_faults_leaves_no_rejects(spark, tmp_path):
    (tmp_path / "m.csv").write_text("movieId,title,genres\n1,a,x\n")
    movies = read_bronze(spark, MOVIES, f"{tmp_path}/m.csv", rejects=True)
    runs = pipelines.clean_to_silver({"movies": movies}, f"{tmp_path}/silver", SPECS, rejects=f"{tmp_path}/rejects")
    assert (runs["movies"].scanned, runs["movies"].unparsed, runs["movies"].written.rows) == (1, 0, 1)
    assert not (tmp_path / "rejects").exists()


def test_bronze_is_scanned_once(spark, tmp_path):
    evaluated = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def counted(x):
        evaluated.add(1)
        return x

    rating = counted.asNondeterministic()(F.col("rating"))
    base = spark.range(1000).selectExpr("cast(id as int) userId", "1 movieId", "cast(3.0 as double) rating", "id timestamp")
    bronze = base.withColumn("rating", rating)
    runs = pipelines.clean_to_silver({"ratings": bronze}, f"{tmp_path}/silver", SPECS)
    assert (runs["ratings"].scanned, runs["ratings"].written.rows, evaluated.value) == (1000, 1000, 1000)
    pipelines.run_report(spark, runs).collect()
    assert evaluated.value == 1000


def test_empty_tables_run(spark, tmp_path):
    empty = {name: spark.createDataFrame([], spec.schema) for name, spec in SPECS.items()}
    runs = pipelines.clean_to_silver(empty, f"{tmp_path}/silver", SPECS)
    assert all((r.scanned, r.unparsed, r.written.rows, r.written.digest) == (0, 0, 0, "0") for r in runs.values())
    assert all(r.same_rows and r.same_content for r in pipelines.verify_silver_content(spark, f"{tmp_path}/silver", runs).collect())
    assert {r.pct_removed for r in pipelines.run_report(spark, runs).collect()} == {None}


ROWS = [(1, "a", None), (2, None, "a"), (3, "", "b"), (3, "", "b")]


def digest(df):
    return df.agg(content_digest(df.columns)).first()[0]


def test_digest_sees_content_and_not_order(spark):
    df = spark.createDataFrame(ROWS, "k int, `x.y` string, z string")
    assert digest(df) == digest(df.orderBy(F.desc("k")).select("z", "`x.y`", "k").repartition(3))
    changes = [
        [(1, "b", None), *ROWS[1:]], ROWS[:3], [*ROWS, ROWS[0]], [(1, None, "a"), *ROWS[1:]],
        [*ROWS[:2], (3, None, "b"), (3, "", "b")], [(2, "a", None), (1, None, "a"), *ROWS[2:]],
    ]
    others = [digest(spark.createDataFrame(rows, df.schema)) for rows in changes]
    assert digest(df) not in others and len(set(others)) == len(others)


def test_a_changed_cell_is_noticed(spark, tmp_path):
    df = spark.range(1000).selectExpr("id", "id % 7 as part", "cast(id as string) as text")
    written = write_parquet_checked(df, f"{tmp_path}/t", partition_by=("part",))
    good = verify_content(spark, {"t": (spark.read.parquet(f"{tmp_path}/t").withColumn("part", F.col("part").cast("long")), written)}).first()
    assert tuple(good) == ("t", 1000, 1000, True, True)
    changed = spark.read.parquet(f"{tmp_path}/t").withColumn("part", F.col("part").cast("long"))
    changed = changed.withColumn("text", F.when(F.col("id") == 500, "5OO").otherwise(F.col("text")))
    bad = verify_content(spark, {"t": (changed, written)}).first()
    assert tuple(bad) == ("t", 1000, 1000, True, False)


def test_write_in_place(spark, tmp_path):
    rows = spark.range(0, 6000, numPartitions=3).selectExpr("id", "cast(1995 + id % 4 as int) as year")

    def files(name):
        return len(list((tmp_path / name).glob("year=*/*.parquet")))

    assert write_parquet(rows, f"{tmp_path}/gathered", partition_by=("year",)) == 6000
    assert write_parquet(rows, f"{tmp_path}/in_place", partition_by=("year",), gather=False) == 6000
    assert files("gathered") == 4 and files("in_place") == 12
    again = spark.read.parquet(f"{tmp_path}/in_place")
    assert again.exceptAll(spark.read.parquet(f"{tmp_path}/gathered")).isEmpty() and again.count() == 6000


def test_in_place_has_one_shuffle(spark, tmp_path, monkeypatch):
    """That of the de-duplication alone; the other way has one more."""
    plans = []

    def spy(writer, path, *args, **options):
        plans.append(writer._df._jdf.queryExecution().executedPlan().toString())
        written(writer, path, *args, **options)

    written = DataFrameWriter.parquet
    spark.range(100).selectExpr("cast(id as int) userId", "1 movieId", "3.0D rating", "id timestamp").write.parquet(f"{tmp_path}/bronze")
    monkeypatch.setattr(DataFrameWriter, "parquet", spy)
    silver = cleaning.clean(spark.read.parquet(f"{tmp_path}/bronze"), RATINGS)
    for gather in (True, False):
        write_parquet(silver, f"{tmp_path}/{gather}", partition_by=("year",), gather=gather)
    assert [p.count("Exchange hashpartitioning(") for p in plans] == [2, 1]
