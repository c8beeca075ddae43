"""Quality of texts without spaces."""

import random
import re

import pytest

from cinetally.llm import quality


def test_pieces_hold_the_whole_word():
    word = "var aB3=".replace(" ", "") * 30 + "漢字仮名" + "é_" * 40 + "x" * 100 + "́ไทย😀"
    pieces = list(quality._cut(word))
    assert {c for p in pieces for c in p} == set(word) and max(map(len, pieces)) <= quality.WORD_CHARS
    assert list(quality._cut("plain,")) == ["plain,"] and list(quality._cut("漢字仮")) == ["漢字", "字仮"] and list(quality._cut("漢")) == ["漢"]
    assert "".join(quality._KINDS.findall(word)) == word


@pytest.mark.parametrize("start", ["x" * 64, "漢" * 64])
def test_the_score_rests_on_all_of_a_text_without_spaces(start):
    tails = ["return(value);if(a==b){count+=1;}" * 20, "今日は天気がよいので散歩に行きました" * 20]
    vectors = [set(quality._counts(start + t)[0]) for t in tails]
    assert len(vectors[0] ^ vectors[1]) > 8
    # Two texts in a shared vocabulary meet in most buckets.
    rng = random.Random(3)
    parts = re.findall("..", "今日明天気良悪散歩食事本読書山川海空")
    one, two = (set(quality._counts(start + "".join(rng.choices(parts, k=400)))[0]) for _ in range(2))
    assert len(one & two) > 0.8 * len(one | two)


def test_shapes_are_whole():
    assert quality._terms("a-b-c-d-e-f-g-h")[1] != quality._terms("a-b-c-d-e-f-g.1.2.3")[1]


def test_texts_without_spaces_are_told_apart(spark):
    rng = random.Random(5)
    good, bad = re.findall("..", "今日天気散歩食事読書山川海空花鳥風月"), re.findall("..", "無料当選賞金登録急募副業即金儲万円高額")
    rows = [(i, ("文" * 64 + "".join(rng.choices(good if i % 2 else bad, k=100)))) for i in range(240)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, quality int")
    held = [r for r in quality.score(docs, labels).collect() if r.held_out]
    assert len(held) > 40 and all(r.predicted == r.doc_id % 2 for r in held)


def test_voters_are_as_many_as_the_accuracy_was_measured_with():
    assert quality.VOTERS == 2_000
