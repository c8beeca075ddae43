"""Exact and near de-duplication."""

import hashlib
import re
from collections import Counter

import numpy as np
import pytest
from awkward_rows import awkward, clashing  # noqa: F401
from conftest import TESTDATA
from pyspark.sql import functions as F

from cinetally.llm import exact_dedup, near_dedup
from cinetally.sources.scratch import Scratch


def same(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def test_awkward_rows(awkward):
    rows = exact_dedup.decisions(awkward).collect()
    assert len(rows) == awkward.count()
    texts = [(r.doc_id, same(r.text)) for r in awkward.collect()]
    size = Counter(t for _, t in texts)
    by_hash = {hashlib.sha256(t.encode()).hexdigest(): t for t in size}
    smallest = {}
    for i, t in texts:
        if i is not None:
            smallest[t] = min(i, smallest.get(t, i))
    for r in rows:
        text = by_hash[r.text_sha256]
        assert (r.group_size, r.keep_id) == (size[text], smallest.get(text))
    assert Counter(by_hash[r.text_sha256] for r in rows if r.kept) == Counter(set(size))


def test_a_weak_digest_is_checked_by_the_bytes(awkward):
    weak = exact_dedup.decisions(awkward, digest=lambda t: F.unhex(F.hex(F.length(t) % 2)), batch_bytes=1)
    columns = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert weak.select(columns).exceptAll(exact_dedup.decisions(awkward).select(columns)).isEmpty()


def test_empty_tables(spark, awkward):
    none = awkward.limit(0)
    assert exact_dedup.decisions(none).isEmpty() and exact_dedup.keep_first(none).isEmpty()
    assert near_dedup.classes(none).isEmpty() and near_dedup.keep_one(none).isEmpty()


# Of 13 rows: three are the sentence on the fox, three are empty, two are "one two"; one of only white space has no words either.
@pytest.mark.parametrize("keep, rest", [(exact_dedup.keep_first, 8), (near_dedup.keep_one, 7)])
def test_other_columns_stay(clashing, keep, rest):
    kept = keep(clashing)
    assert kept.columns == clashing.columns and kept.count() == rest
    assert kept.exceptAll(clashing).isEmpty()


def test_state_settings_are_put_back(spark, awkward):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    exact_dedup.decisions(awkward)
    assert spark.conf.get(key) == before


# Near-duplicates


def shingles(text):
    words = [w for w in re.sub(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " ", (text or "").lower()).split(" ") if w]
    return Counter(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else Counter()


def jaccard(x, y):
    every = x.keys() | y.keys()
    return sum(1 / sum(max(x[j] / x[k], y[j] / y[k]) for j in every) for k in x.keys() & y.keys())


def brute_classes(rows):
    grams = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            a, b = grams[i], grams[j]
            if a == b or (a and b and len(a & b) * 2 > min(len(a), len(b)) and jaccard(a, b) >= 0.8):
                parent[root(i)] = root(j)
    members = {}
    for i, (doc, _) in enumerate(rows):
        members.setdefault(root(i), []).append(doc)
    return {tuple(sorted(m, key=lambda d: (d is None, d))) for m in members.values()}


def check_classes(df):
    rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    got = {}
    for r in near_dedup.classes(df).collect():
        got.setdefault(r.class_id, []).append(r)
    assert all(sum(r.kept for r in g) == 1 for g in got.values())
    ids = {tuple(sorted((r.doc_id for r in g), key=lambda d: (d is None, d))) for g in got.values()}
    assert ids == brute_classes(rows)


def test_classes_of_documents(spark):
    check_classes(spark.read.parquet(f"{TESTDATA}/sf0.001/documents.parquet"))


def test_classes_of_edited_copies(spark):
    random = np.random.default_rng(3)
    rows, doc = [], 0
    for _ in range(25):
        base = [f"w{i}" for i in random.integers(0, 5000, random.integers(4, 150))]
        for edits in random.integers(0, 6, 12):
            words = list(base)
            for at in random.integers(0, len(words), edits):
                words[at] = f"v{random.integers(0, 5000)}"
            rows.append((doc, " ".join(words)))
            doc += 1
    check_classes(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))


def test_blocks_find_what_one_block_finds(spark, monkeypatch):
    """A bucket dealt out to several cells; the star of the leaders is left out."""
    base = [f"w{i}" for i in range(60)]
    rows = []
    for doc in range(40):
        words = list(base)
        words[doc] = f"v{doc}"
        rows.append((doc, " ".join(words)))
    monkeypatch.setattr(near_dedup, "BLOCK", 7)
    check_classes(spark.createDataFrame(rows, "doc_id long, text string"))


def test_estimates_and_similarity_of_weighted_shingles():
    random = np.random.default_rng(1)
    a = random.integers(1, 1 << 62, 300)
    weights = random.integers(1, 5, 300)
    first = np.repeat(a, weights)
    second = np.repeat(a[40:], np.where(random.random(260) < 0.2, 6, weights[40:]))
    exact = near_dedup.similarity(near_dedup.multiset(first), near_dedup.multiset(second))
    count_a, count_b = Counter(first.tolist()), Counter(second.tolist())
    assert exact == pytest.approx(jaccard(count_a, count_b))
    lengths = np.array([len(first), len(second), 0])
    signed = near_dedup.signatures(lengths, np.concatenate([first, second]), 4096)
    assert (signed[0] == signed[1]).mean() == pytest.approx(exact, abs=0.03)
    assert not signed[2].any()


def test_components(spark):
    links = [(9, 8), (8, 7), (7, 6), (1, 2), (2, 3), (5, 5)] + [(100, 100 + i) for i in range(1, 50)]
    df = spark.createDataFrame(links, "a long, b long")
    got = {r["node"]: r["class"] for r in near_dedup.components(df, Scratch(spark)).collect()}
    assert {k: v for k, v in got.items() if k < 50} == {9: 6, 8: 6, 7: 6, 6: 6, 1: 1, 2: 1, 3: 1}
    assert {v for k, v in got.items() if k >= 100} == {100} and len(got) == 57
