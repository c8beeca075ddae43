"""The command line over a small bronze folder."""

import pytest

from cinetally import jobs

TABLES = {
    "movies": 'movieId,title,genres\n1," One, The (1999) ",A|B\n2,Two (2000),(no genres listed)\n',
    "ratings": "userId,movieId,rating,timestamp\n1,1,4.0,964982703\n2,1,5.0,964982703\n"
    "1,2,4.5,1230768000\n1,2,4.5,1230768000\n3,2,9.0,1230768000\n",
    "tags": "userId,movieId,tag,timestamp\n1,1, Fun ,964982703\n",
    "links": "movieId,imdbId,tmdbId\n1,0114709,862\n2,0113497,\n",
}


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("lake")
    (root / "bronze").mkdir()
    for name, text in TABLES.items():
        (root / "bronze" / f"{name}.csv").write_text(text)
    jobs.main(["clean", "--bronze", f"{root}/bronze", "--silver", f"{root}/silver"])
    return root


def test_ingest(lake, capsys):
    jobs.main(["ingest", "--bronze", f"{lake}/bronze"])
    out = capsys.readouterr().out
    assert "|ratings|5     |" in out
    assert "|3       |rating   |double|true    |" in out


def test_clean_report(lake, spark, capsys):
    jobs.main(
        ["clean", "--bronze", f"{lake}/bronze", "--silver", f"{lake}/strict", "--strict-links",
         "--fold-case"]
    )
    out = capsys.readouterr().out
    assert "|ratings|5       |0         |3      |2        |0.0         |40.0" in out
    assert "|links  |2       |0         |1      |1        |0.0         |50.0" in out
    assert spark.read.parquet(f"{lake}/strict/tags").first()["tag"] == "fun"


def test_analyse(lake, capsys):
    jobs.main(
        ["analyse", "--silver", f"{lake}/silver", "--gold", f"{lake}/gold", "--min-votes", "1",
         "--min-votes-per-genre", "1", "--files", "1"]
    )
    out = capsys.readouterr().out
    assert "|1      |One, The (1999)|4.5       |2        |" in out
    assert "|NULL |4.5                |1        |" in out
    assert "|users     |2    |" in out


def test_explore(lake, capsys):
    jobs.main(["explore", "--silver", f"{lake}/silver", "--year", "2009"])
    out = capsys.readouterr().out
    assert "|one_year    |2009  |1  |" in out and "|high_ratings|4.0   |3  |" in out


def test_profile(lake, capsys):
    jobs.main(["profile", "--bronze", f"{lake}/bronze"])
    out = capsys.readouterr().out
    assert "|links  |tmdbId   |string|1        |50.0" in out
    assert "links: frequent values" in out
