import os

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.sql import functions as F, types as T

from cinetally.operators.joins import explode_list
from cinetally.plans import pipelines
from cinetally.schemas import LINKS, MOVIES, RATINGS, SPECS, wide_keys
from cinetally.sources.readers import read_bronze, read_silver, read_silver_tables
from cinetally.sources.scratch import Scratch, shared_folder
from cinetally.sources.writers import write_csv, write_parquet


def put(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


MOVIES_CSV = """movieId,title,genres
1," A, The (1995) ",X|Y
bad,C,Z
4,D (1997)
5,E,a||b
"""


def test_csv_edge_rows(spark, tmp_path):
    df = read_bronze(spark, MOVIES, put(tmp_path / "m.csv", MOVIES_CSV))
    got = {r["title"]: (r["movieId"], r["genres"]) for r in df.collect()}
    assert got[" A, The (1995) "] == (1, "X|Y")
    assert got["C"] == (None, "Z")
    assert got["D (1997)"] == (4, None)
    items = explode_list(df.filter("movieId in (4, 5)")).collect()
    assert sorted(r["genre"] for r in items) == ["", "a", "b"]


def test_swapped_header(spark, tmp_path):
    path = put(tmp_path / "l.csv", "imdbId,movieId,tmdbId\n0114709,1,862\n")
    with pytest.raises(Py4JJavaError):
        read_bronze(spark, LINKS, path).collect()
    misread = read_bronze(spark, LINKS, path, strict_header=False).first()
    assert tuple(misread) == (114709, "1", "862")


def test_failfast_mode(spark, tmp_path):
    path = put(tmp_path / "m.csv", MOVIES_CSV)
    with pytest.raises(Py4JJavaError):
        read_bronze(spark, MOVIES, path, mode="FAILFAST").collect()


def test_leading_zeros(spark, tmp_path):
    path = put(tmp_path / "l.csv", "movieId,imdbId,tmdbId\n1,0114709,\n")
    assert tuple(read_bronze(spark, LINKS, path).first()) == (1, "0114709", None)
    assert read_bronze(spark, LINKS, path, infer=True).first()["imdbId"] == 114709


def test_csv_roundtrip_keeps_spaces_nulls_and_quotes(spark, tmp_path):
    data = [(1, '  "quoted", with comma ', None), (2, "\\ ", "\ta "), (3, None, "x|y")]
    path = str(tmp_path / "m")
    assert write_csv(spark.createDataFrame(data, MOVIES.schema), path) == 3
    assert sorted(map(tuple, read_bronze(spark, MOVIES, path).collect())) == data


def test_empty_text_reads_back_as_null(spark, tmp_path):
    path = str(tmp_path / "m")
    write_csv(spark.createDataFrame([(1, "", "x")], MOVIES.schema), path)
    assert tuple(read_bronze(spark, MOVIES, path).first()) == (1, None, "x")


def test_sorted_result_in_one_file(spark, tmp_path):
    path = str(tmp_path / "sorted")
    df = spark.range(1000).repartition(7).orderBy(F.desc("id"))
    assert write_csv(df, path, files=1) == 1000
    files = [f for f in os.listdir(path) if f.endswith(".csv")]
    assert len(files) == 1
    lines = open(f"{path}/{files[0]}").read().split()
    assert lines == ["id"] + [str(i) for i in reversed(range(1000))]


def test_wide_keys_keep_large_ids(spark, tmp_path):
    path = put(tmp_path / "l.csv", "movieId,imdbId,tmdbId\n9000000000,01,1\n")
    assert read_bronze(spark, LINKS, path).first()["movieId"] is None
    assert read_bronze(spark, wide_keys()["links"], path).first()["movieId"] == 9000000000


def test_partitioned_write_and_pruned_scan(spark, tmp_path):
    df = spark.range(300).select(
        F.col("id").cast("int").alias("userId"),
        F.lit(1).alias("movieId"),
        F.lit(3.0).alias("rating"),
        F.timestamp_seconds("id").alias("timestamp"),
        (2000 + F.col("id") % 3).cast("int").alias("year"),
        *(F.lit(1).alias(c) for c in ("month", "day", "dayOfWeek", "hour")),
    )
    rows = write_parquet(
        df.repartition(8), f"{tmp_path}/ratings", partition_by=("year",)
    )
    assert rows == 300
    for year in (2000, 2001, 2002):
        files = os.listdir(f"{tmp_path}/ratings/year={year}")
        assert len([f for f in files if f.endswith(".parquet")]) == 1
    stored = read_silver(spark, str(tmp_path), RATINGS)
    assert stored.columns[-1] == "year"
    assert stored.schema["year"].dataType == T.IntegerType()
    one = stored.filter("year = 2001")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan
    assert one.count() == 100


def test_hot_partition_is_split_between_tasks(spark, tmp_path):
    wide = spark.range(0, 200_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 2001).otherwise(2000).alias("year"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"),
    )
    option = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(option)
    spark.conf.set(option, "1m")
    try:
        assert write_parquet(wide, f"{tmp_path}/hot", partition_by=("year",)) == 200_000
    finally:
        spark.conf.set(option, before)
    files = os.listdir(f"{tmp_path}/hot/year=2000")
    assert len([f for f in files if f.endswith(".parquet")]) > 3


def test_empty_tables_pass_through_the_pipeline(spark, tmp_path):
    bronze = {name: spark.createDataFrame([], spec.schema) for name, spec in SPECS.items()}
    written = pipelines.bronze_to_silver(bronze, f"{tmp_path}/silver")
    assert written == dict.fromkeys(SPECS, 0)
    stored = read_silver_tables(spark, f"{tmp_path}/silver")
    assert [df.count() for df in stored.values()] == [0, 0, 0, 0]


def test_scratch_uses_the_session_folder_and_releases(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark) == folder
    with Scratch(spark) as scratch:
        table = scratch.table(spark.range(5))
        assert scratch.root.startswith(folder) and table.count() == 5
        assert os.path.isdir(scratch.root)
    assert not os.path.exists(scratch.root)
