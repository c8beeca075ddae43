"""The n-gram join against a loop over all pairs."""

import random

import numpy as np
import pytest
from awkward_rows import awkward, clashing  # noqa: F401
from conftest import TESTDATA

from cinetally.llm import ngram_join as nj


def words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in lower).split(" ") if w]


def grams(text, size=4):
    w = words(text)
    return {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def brute(rows, size=4, percent=85):
    sets = [grams(t, size) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j]:
                shared = len(sets[i] & sets[j])
                if 100 * shared >= percent * (len(sets[i]) + len(sets[j]) - shared):
                    parent[root(i)] = root(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        least.setdefault(root(i), []).append(doc_id)
    least = {r: min((i for i in ids if i is not None), default=None) for r, ids in least.items()}
    return sorted([(doc_id, len(sets[i]), least[root(i)]) for i, (doc_id, _) in enumerate(rows)], key=repr)


def joined(df, **options):
    return sorted(map(tuple, nj.link(df, **options).collect()), key=repr)


def edited(rng, vocabulary, copies, edits):
    base = rng.choices(vocabulary, k=rng.randint(12, 80))
    for _ in range(copies):
        own = list(base)
        for _ in range(rng.randint(0, edits)):
            own[rng.randrange(len(own))] = rng.choice(vocabulary)
        yield " ".join(own)


@pytest.fixture(scope="module")
def texts(awkward):
    rng = random.Random(13)
    vocabulary = [f"w{i}" for i in range(40)] + ["É", "漢", "A", "a."]
    every = [t for _ in range(25) for t in edited(rng, vocabulary, rng.randint(1, 8), 3)]
    # A passage that many share, and short texts around the border of four words.
    passage = " ".join(rng.choices(vocabulary, k=30))
    every += [" ".join(rng.choices(vocabulary, k=rng.randint(0, 60))) + " " + passage for _ in range(40)]
    every += [" ".join(rng.choices(["x", "y"], k=rng.randint(0, 6))) for _ in range(40)]
    rng.shuffle(every)
    return [*enumerate(every), *((r.doc_id, r.text) for r in awkward.collect())]


def test_components_are_those_of_all_pairs(spark, texts):
    df = spark.createDataFrame(texts, "doc_id long, text string")
    assert joined(df) == brute(texts)


def test_other_sizes_and_thresholds(spark, texts):
    df = spark.createDataFrame(texts, "doc_id long, text string")
    assert joined(df, words=2, percent=60) == brute(texts, 2, 60)


def test_large_blocks_and_chunks(spark, texts, monkeypatch):
    """As if every element were common: blocks of a few rows, of which large ones send only what joins classes."""
    monkeypatch.setattr(nj, "BLOCK", 5)
    monkeypatch.setattr(nj, "SMALL", 2)
    df = spark.createDataFrame(texts, "doc_id long, text string")
    assert joined(df, words=2, percent=60) == brute(texts, 2, 60)


def test_a_chain_of_links(spark):
    base = [f"t{i}" for i in range(100)]
    rows = []
    for step in range(12):
        base[step * 8] = f"n{step}"
        rows.append((50 - step, " ".join(base)))
    got = joined(spark.createDataFrame(rows, "doc_id long, text string"))
    assert got == brute(rows) and {g[2] for g in got} == {39}


def test_empty_tables_and_clashing_names(spark, awkward, clashing):
    assert nj.link(awkward.limit(0)).isEmpty()
    empty = spark.createDataFrame([(1, None), (2, ""), (None, " \t")], "doc_id long, text string")
    assert joined(empty) == sorted([(1, 0, 1), (2, 0, 2), (None, 0, None)], key=repr)
    assert joined(clashing) == brute([(r.doc_id, r.text) for r in awkward.collect()])


def test_words_are_hashed_as_they_are(monkeypatch):
    rng = random.Random(2)
    pieces = ["a", "B", " ", "\n", "\t\t", "é", "😀", "word", "x" * 70, "\x0b", "\x1c", " "]
    texts = ["".join(rng.choices(pieces, k=rng.randint(0, 40))) for _ in range(300)] + ["", " ", "a", "a" * 9000]
    octets = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(o) for o in octets])])
    for once in (1 << 20, 64):
        monkeypatch.setattr(nj, "OCTETS", once)
        counts, hashes = nj.word_hashes(np.frombuffer(b"".join(octets), np.uint8), offsets)
        assert counts.tolist() == [len(words(t)) for t in texts]
        flat = [w for t in texts for w in words(t)]
        assert len(set(zip(flat, hashes.tolist()))) == len(set(flat)) == len(set(hashes.tolist()))


def test_bitmaps_never_differ_more_than_the_sets():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(-(2**62), 2**62, rng.integers(1, 3000))) for _ in range(40)]
    sets += [np.union1d(s[: len(s) * 9 // 10], rng.integers(-(2**62), 2**62, 5)) for s in sets]
    bits = nj.Bitmaps([nj.bitmap(s) for s in sets])
    a, b = np.triu_indices(len(sets), 1)
    near = np.maximum(bits.width[a], bits.width[b]) <= 2 * np.minimum(bits.width[a], bits.width[b])
    a, b = a[near], b[near]
    found = bits.differing(a, b)
    for i, j, d in zip(a.tolist(), b.tolist(), found.tolist()):
        assert d <= len(np.setxor1d(sets[i], sets[j]))


def test_documents(spark):
    docs = spark.read.parquet(f"{TESTDATA}/sf0.001/documents.parquet")
    assert joined(docs) == brute([(r.doc_id, r.text) for r in docs.collect()])
