"""Fill-in-the-middle against plain Python."""

import hashlib
import random
import re

import pytest
from awkward_rows import awkward, clashing  # noqa: F401
from pyspark.sql import functions as F

from cinetally.llm import fill_in_middle as fim

ODD = ["", None, "a", "1", "<P>", "x <S> y", "<M", "<P", "S>", "ab<", "$1 \\2 \\E $0", "\n\r\n\t a b", "é漢字😀😀x", "\x00\x00", "a" * 5000, "a-" * 30_000, "<\n>" * 50, "(?s)[a]{2}+", "\U0010ffff퟿"]


def cut(doc_id, text, plain=10, spm=20, seed="1:"):
    text = text or ""
    h = hashlib.sha256((seed + ("" if doc_id is None else str(doc_id))).encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i : 8 * i + 8], 16) for i in range(4))
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    n = len(units)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 100 - plain:
        return (doc_id, n, "plain", None, None, text)
    form = "spm" if h4 % 100 < spm else "psm"
    out = f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"
    return (doc_id, n, form, len(p), len(m), out)


@pytest.fixture(scope="module")
def rows(spark, awkward):
    rng = random.Random(12)
    bits = ["word", "Zz", " ", "\n", "é", "😀", "<", ">", "P", "<P", "S>", "$", "\\", "7"]
    many = [(100 + i, "".join(rng.choices(bits, k=rng.randint(0, 60)))) for i in range(600)]
    df = spark.createDataFrame([*((-i, t) for i, t in enumerate(ODD)), *many], "doc_id long, text string")
    return df.unionByName(awkward).collect()


def test_cuts_are_those_of_the_contract(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = list(map(tuple, fim.transform(df).collect()))
    assert got == [cut(r.doc_id, r.text) for r in rows]
    assert {g[2] for g in got} == {"plain", "psm", "spm"}


def test_texts_come_back_exactly(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    every = fim.transform(df, plain_percent=0, spm_percent=50)
    back = every.withColumn("back", fim.restored(F.col("output"), F.col("form"))).collect()
    assert [b.back for b in back] == [r.text or "" for r in rows]
    for digest, whole in zip(fim.digests(every).collect(), back, strict=True):
        assert digest.output_sha256 == hashlib.sha256(whole.output.encode()).hexdigest()
        assert digest.restored_sha256 == hashlib.sha256(whole.back.encode()).hexdigest()


def test_other_marks_and_seeds(spark, rows):
    marks = fim.Marks("[pre.]", "[suf$]", "[mid\\]")
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = fim.transform(df, seed="7:", marks=marks, plain_percent=0)
    for g, r in zip(got.withColumn("back", fim.restored(F.col("output"), F.col("form"), marks)).collect(), rows, strict=True):
        assert g.back == (r.text or "")
        expected = cut(r.doc_id, (r.text or "").replace("<", "‹"), plain=0, seed="7:")
        if g.form != "plain":
            assert (g.form, g.prefix_chars, g.middle_chars) == expected[2:5]


def test_a_very_long_text_needs_no_stack(spark):
    text = "word-" * 400_000
    got = fim.transform(spark.createDataFrame([(i, text) for i in range(3)], "doc_id long, text string"), plain_percent=0).collect()
    assert [tuple(g) for g in got] == [cut(i, text, plain=0) for i in range(3)]


@pytest.mark.parametrize("marks", [("", "b", "c"), ("a", "a", "c"), ("<a", "<a<", "x"), ("ab", "bc", "xx")])
def test_marks_that_could_be_mistaken(marks):
    with pytest.raises(ValueError):
        fim.Marks(*marks)


def test_empty_tables_and_clashing_names(spark, awkward, clashing):
    assert fim.transform(awkward.limit(0)).isEmpty() and fim.digests(fim.transform(awkward.limit(0))).isEmpty()
    assert sorted(map(tuple, fim.transform(clashing).collect()), key=repr) == sorted(map(tuple, fim.transform(awkward).collect()), key=repr)


def test_no_python_in_the_plan(awkward):
    plan = fim.digests(fim.transform(awkward))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
