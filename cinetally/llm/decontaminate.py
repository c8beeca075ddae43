"""Benchmark decontamination in built-in functions.

The search is for test items that are contained in documents, however long
these are, so the sketch is one-sided: of each item the smallest hashes of its
shingles are looked up among all shingles of a document. Items are partitioned
by size, and each size has as many hashes as make sure that a document with
enough of the item's shingles has one of them at least. What the sketch
finds is verified by counting the shared shingles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cinetally.llm.common import FILE, ROW, col, located, maybe_members, membership_bits, text_of, without
from cinetally.llm.shingles import shingles_of, shingles_or_whole, word_hashes
from cinetally.sources.scratch import Scratch

WORDS = 5
THRESHOLD = 0.8


def _sketch_size(shingles: Column, threshold: float) -> Column:
    """Hashes in the sketch of an item of that size: enough for the largest of its power of two.

    An item of n shingles of which a document lacks less than s is found by any s of them.
    """
    largest = F.pow(F.lit(2.0), F.floor(F.log2(shingles)) + 1) - 1
    return (largest - F.ceil(threshold * largest - 1e-9) + 1).cast("int")


class Items:
    """Test items as written tables: shingles (item, hash, n) and sketches (item, hash, n)."""

    def __init__(self, benchmark: DataFrame, id_col: str, text_col: str, size: int, threshold: float, work: Scratch) -> None:
        rows = benchmark.select(col(id_col).alias("item_id"), text_of(text_col).alias("text")).distinct()
        hashed = word_hashes(rows, "item_id")
        whole = hashed.select(
            "item_id", F.least(F.size("h"), F.lit(size)).alias("size"),
            F.expr(f"array_sort(array_distinct({shingles_or_whole('h', size)}))").alias("s"),
        )
        # Written, so that the numbering of the items is fixed, and before the filter, which would
        # otherwise be pushed into the expressions above and compute them for each element.
        whole = work.table(whole.withColumn("item", F.monotonically_increasing_id()), "items")
        self.whole = whole.withColumn("n", F.size("s")).filter("n > 0")
        self.names = self.whole.select("item", "item_id")
        self.shingles = self.whole.select("item", "n", F.explode("s").alias("hash"))
        sketch = F.slice("s", F.lit(1), F.least(F.col("n"), _sketch_size(F.col("n"), threshold)))
        self.sketches = self.whole.select("item", "n", F.explode(sketch).alias("hash"))
        self.sizes = [r["size"] for r in self.whole.select("size").distinct().collect()]


def _exploded(rows: DataFrame, sizes: list[int]) -> DataFrame:
    """(file, row, n, hash) of the distinct shingles of each text; n is how many it has."""
    hashed = word_hashes(rows, FILE, ROW)
    every = F.expr("array_distinct(concat(" + ", ".join(shingles_of("h", k) for k in sizes) + "))")
    # The outer form: from the plain one a filter on the array's size is inferred, which computes the array once more.
    # The size is never null, as far as the optimizer can tell: else a comparison with it puts a check for null below, with the
    # whole array folded into one expression that computes the words' hashes again for each word.
    size = F.coalesce(F.size("s"), F.lit(0))
    exploded = hashed.select(FILE, ROW, every.alias("s")).select(FILE, ROW, size.alias("doc_n"), F.explode_outer("s").alias("hash"))
    return exploded.filter("hash IS NOT NULL")


def _contained(rows: DataFrame, benchmark: DataFrame, item_id: str, item_text: str, size: int, threshold: float, work: Scratch) -> DataFrame:
    """(file, row, item_id, n_shared, n_shingles, containment) of rows (file, row, text)."""
    items = Items(benchmark, item_id, item_text, size, threshold, work)
    need = F.ceil(threshold * F.col("n") - 1e-9)
    sizes = items.sizes or [size]

    bits = work.table(membership_bits(items.sketches, F.col("hash")), "sketch_bits")
    hits = maybe_members(_exploded(rows, sizes), F.col("hash"), bits).join(items.sketches, "hash")
    candidates = work.table(hits.filter(F.col("doc_n") >= need).select(FILE, ROW, "item").distinct(), "candidates")

    place = F.struct(FILE, ROW)
    # An inner join: a semi join would be pushed below the one with the bitmap, and shuffle all texts.
    texts = candidates.select(FILE, ROW).distinct()
    found = maybe_members(rows, place, membership_bits(candidates, place)).join(texts, [FILE, ROW])
    shared = _exploded(found, sizes).join(items.shingles, "hash").groupBy(FILE, ROW, "item").agg(
        F.count(F.lit(1)).alias("n_shared"), F.first("n").alias("n")
    )
    exact = shared.filter(F.col("n_shared") >= need).join(candidates, [FILE, ROW, "item"], "left_semi")
    return exact.join(items.names, "item").select(
        FILE, ROW, "item_id", "n_shared", F.col("n").cast("bigint").alias("n_shingles"), (F.col("n_shared") / F.col("n")).alias("containment")
    )


def search(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    *,
    item_id: str = "item_id",
    item_text: str = "text",
    size: int = WORDS,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """One row per document and test item in it: doc_id, item_id, n_shared, n_shingles, containment.

    A document contains an item when it has at least ``threshold`` of the item's
    distinct shingles of ``size`` words, anywhere in the text. Items of fewer
    words have the one shingle of their own length. Items without words (null,
    empty) are contained nowhere, documents without words contain nothing.
    Items that agree in id and text count once; each row of ``docs`` is
    searched on its own, null ids included. Empty tables give an empty result;
    other columns are not read.
    """
    work = Scratch(docs.sparkSession)
    rows = located(docs.select(col(id_col).alias("doc_id"), text_of(text_col).alias("text")), work)
    found = work.table(_contained(rows.select(FILE, ROW, "text"), benchmark, item_id, item_text, size, threshold, work), "found")
    place = F.struct(FILE, ROW)
    named = maybe_members(rows.drop("text"), place, membership_bits(found, place))
    return named.join(found, [FILE, ROW]).drop(FILE, ROW)


def keep_clean(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", *, item_id: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """The rows of ``docs`` that contain no test item, with all their columns."""
    work = Scratch(docs.sparkSession)
    rows = located(docs, work)
    texts = rows.select(FILE, ROW, text_of(text_col).alias("text"))
    found = _contained(texts, benchmark, item_id, item_text, WORDS, THRESHOLD, work)
    return without(rows, work.table(found.select(FILE, ROW).distinct(), "gone"))
