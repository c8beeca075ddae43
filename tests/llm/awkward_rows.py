import pytest

#: Null text, null id, empty and blank text, repeated rows, equal ids, a very long text.
AWKWARD = [
    (1, "The quick brown fox jumps over the lazy dog again and again."),
    (2, "The  quick brown fox\tjumps over the lazy dog again and again."),
    (None, "The quick brown fox jumps over the lazy dog again and again."),
    (3, None),
    (4, ""),
    (5, " \n "),
    (6, "one two"),
    (6, "one two"),
    (6, "another text with the id of the others, which is not theirs"),
    (None, None),
    (7, "word " * 30_000 + "end"),
    (8, "x" * 50_000),
    (9, "é漢字😀 \x00   <|endoftext|> ▁"),
]


@pytest.fixture(scope="module")
def awkward(spark):
    return spark.createDataFrame(AWKWARD, "doc_id long, text string").coalesce(2)


@pytest.fixture(scope="module")
def clashing(spark, tmp_path_factory, awkward):
    """The same rows, stored, with more columns whose names the operators use."""
    path = str(tmp_path_factory.mktemp("clash") / "t")
    names = ["digest", "first", "kept", "keep", "row", "file", "node", "class", "h", "spaced", "item", "item_id", "score",
             "features", "toxic", "label", "n", "score.a", "token", "pieces"]
    awkward.selectExpr("*", *(f"cast(doc_id as string) as `{n}`" for n in names)).write.parquet(path)
    return spark.read.parquet(path)
