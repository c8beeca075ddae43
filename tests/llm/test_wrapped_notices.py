"""Notices that are wrapped over lines."""

import random
import textwrap

import pytest
from cinetally.llm import licenses
from test_scans import words

NOTICES = [(i, t, label) for i, (t, label) in enumerate(licenses.TEMPLATES)]


@pytest.mark.parametrize("width, lead", [(79, ""), (72, "# "), (60, " * "), (40, "// ")])
def test_wrapped_notices_are_found(spark, width, lead):
    rows = [(i, "int x;\n" * 37 + textwrap.fill(t, width, initial_indent=lead, subsequent_indent=lead) + "\nint y;" * 40) for i, t, _ in NOTICES]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in licenses.scan(df).collect()}
    for i, _, label in NOTICES:
        assert label in got[i].labels.split(",") and got[i].score == 1 and i in {m.template for m in got[i].matches}


def test_blocks_of_lines_and_of_the_text(spark):
    random.seed(5)
    vocabulary = [w for t, _ in licenses.TEMPLATES for w in t.split()] + ["\n", "\n", "\r\n", "foo", "é"]
    rows = [(i, " ".join(random.choices(vocabulary, k=random.randint(0, 120)))) for i in range(150)] + [(200, None), (201, "\n")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    plain = {r.doc_id: r for r in licenses.scan(df, across_lines=False).collect()}
    more = 0
    for r in licenses.scan(df).collect():
        w, lines = words(dict(rows)[r.doc_id]), [m for m in r.matches if m.line is not None]
        found = []
        for b, s in enumerate(range(0, max(1, len(w) - 32 + 8), 8) if w else []):
            for t, template, _ in NOTICES:
                tokens = set(template.split())
                share = len(tokens & set(w[s : s + 32])) / len(tokens)
                if share >= 0.8 - 1e-9:
                    found.append((t, b, share))
        assert sorted((m.template, m.block, m.containment) for m in r.matches if m.line is None) == sorted(found)
        assert lines == plain[r.doc_id].matches
        base = {x for x in r.base_labels.split(",") if x}
        assert r.labels == ",".join(sorted(base | {licenses.TEMPLATES[m.template][1] for m in r.matches}))
        assert r.score == max([float(bool(base)), *(m.containment for m in r.matches)])
        more += r.labels != plain[r.doc_id].labels
    assert more


def test_templates_of_any_length(spark):
    long = " ".join(f"word{i}" for i in range(150))
    text = "start " * 13 + "\n" + textwrap.fill(long, 60) + "\nend"
    df = spark.createDataFrame([(1, text), (2, text.replace("word1", "other1"))], "doc_id long, text string")
    got = licenses.scan(df, templates=((long, "own"),)).collect()
    assert (got[0].labels, got[0].score) == ("own", 1.0) and got[1].labels == ""
