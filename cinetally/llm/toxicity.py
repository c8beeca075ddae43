"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

The features are densities of lexicon words, their distance from second-person
words, and rates of capitals, punctuation and obfuscation. The lexicons are
learned from labelled rows, over distinct contexts: a word counts once per
word before it, so that copies of one text do not make their words look toxic.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from cinetally.llm.common import FILE, ROW, col, crc_mod, located, smallest_hashes, text_of, without, worker_cache
from cinetally.sources.scratch import Scratch

FOLDS, HELD_OUT, CALIBRATION = 4, 2, 3
THRESHOLD = 0.3
#: Bounds of the labelled samples: texts of each class for the lexicons, rows for the trees.
LEXICON_TEXTS, TREE_ROWS = 5_000, 40_000
LEXICON_WORDS = 2_000
#: Contexts that a task holds before it hands them on.
CONTEXTS = 1 << 16
#: Second-person words of the languages in hand (fixed values).
SECOND_PERSON = frozenset(
    "you your yours yourself u ur du dich dir dein deine deinen ihr euch tu te toi ton ta tes vous votre vos tú ti tus usted ustedes vosotros".split()
)
#: Characters that stand for letters in obfuscated words (fixed values).
LOOKALIKES = str.maketrans("013457@$!", "oieastasi")
NEAR = 5
FEATURES = (
    "strong", "strong_count", "weak", "stems", "stem_count", "near_you", "you", "hidden",
    "capitals", "punctuation", "exclamations", "digits", "obfuscated", "words",
)

_WORD = re.compile(r"[^\W_](?:[\w@$!*'’]*[^\W_])?")
_MASKED = re.compile(r"[^\W\d_][0-9@$!*]+[^\W\d_]")
_CAPITALS = np.zeros(256, bool)
_CAPITALS[65:91] = True
_DIGITS = np.zeros(256, bool)
_DIGITS[48:58] = True
_PUNCTUATION = np.zeros(256, bool)
for _span in ((33, 48), (58, 65), (91, 97), (123, 127)):
    _PUNCTUATION[slice(*_span)] = True


def _words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def _grams(word: str) -> Iterable[tuple[str, str]]:
    if len(word) > 2:
        yield "word", word
    for n in (4, 5, 6):
        if len(word) > n:
            yield f"stem{n}", word[:n]


def _contexts(batches):
    """(kind, gram, word before, toxic) of each text, distinct among those that are held together."""

    def packed(rows):
        parts = list(zip(*rows, strict=True)) or [[], [], [], []]
        return pa.RecordBatch.from_arrays(
            [pa.array(p, t) for p, t in zip(parts, (pa.string(), pa.string(), pa.string(), pa.int32()), strict=True)],
            ["kind", "gram", "before", "toxic"],
        )

    worker_cache("toxicity")  # lets go of what another stage remembered
    rows: set[tuple[str, str, str, int]] = set()
    for batch in batches:
        for text, toxic in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
            before = ""
            for found in _WORD.finditer(text.as_py().lower()):
                word = found.group()
                rows.update((kind, gram, before, toxic) for kind, gram in _grams(word))
                before = word[:12]
                if len(rows) >= CONTEXTS:
                    yield packed(rows)
                    rows.clear()
    if rows:
        yield packed(rows)


def learn_lexicons(texts: DataFrame) -> dict[str, set[str]]:
    """Strong, weak and stem lexicons, of bounded size, from rows (text, toxic) of balanced classes."""
    seen = texts.mapInArrow(_contexts, "kind string, gram string, before string, toxic int")
    per_context = seen.groupBy("kind", "gram", "before").agg(F.max("toxic").alias("toxic"), F.min("toxic").alias("clean"))
    counts = per_context.groupBy("kind", "gram").agg(
        F.sum("toxic").alias("t"), F.sum(1 - F.col("clean")).alias("c")
    )
    share = F.col("t") / (F.col("t") + F.col("c") + 1)
    found = (
        counts.filter("t >= 8").withColumn("share", share).filter("share >= 0.75")
        .orderBy(F.desc(F.col("t") * (F.col("share") - 0.5)), "kind", "gram").limit(LEXICON_WORDS)
        .select("kind", "gram", "share").collect()
    )
    lexicons: dict[str, set[str]] = {"strong": set(), "weak": set(), "stems": set()}
    for r in found:
        if r.kind == "word":
            lexicons["strong" if r.share >= 0.9 else "weak"].add(r.gram)
        elif r.share >= 0.9:
            lexicons["stems"].add(r.gram)
    return lexicons


def _features(text: str, lexicons: dict[str, set[str]]) -> list[float]:
    words = _words(text)
    n = max(1, len(words))
    strong, weak, stems = lexicons["strong"], lexicons["weak"], lexicons["stems"]
    hits = [i for i, w in enumerate(words) if w in strong]
    stemmed = [i for i, w in enumerate(words) if w[:4] in stems or w[:5] in stems or w[:6] in stems]
    second = [i for i, w in enumerate(words) if w in SECOND_PERSON]
    near = 0
    if hits and second:
        at = np.searchsorted(second, hits)
        ends = np.array([-NEAR - 1 - n, *second, 2 * n + NEAR + 1])
        near = int((np.minimum(np.array(hits) - ends[at], ends[at + 1] - np.array(hits)) <= NEAR).sum())
    masked = _MASKED.findall(text) if re.search("[0-9@$!*]", text) else []
    hidden = 0
    if masked:
        hidden = sum(w.translate(LOOKALIKES) in strong for w in words if not w.isalpha())
    octets = np.bincount(np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8), minlength=256)
    chars = max(1, int(octets.sum()))
    return [
        len(hits) / n, float(np.log1p(len(hits))), sum(w in weak for w in words) / n,
        len(stemmed) / n, float(np.log1p(len(stemmed))), near / n, len(second) / n, hidden / n,
        octets[_CAPITALS].sum() / chars, octets[_PUNCTUATION].sum() / chars, octets[33] / chars,
        octets[_DIGITS].sum() / chars, len(masked) / n, float(np.log1p(len(words))),
    ]


def _labels(labels: DataFrame, id_col: str, label_col: str) -> DataFrame:
    """One label per id (the larger one, should there be several), outside the held-out fold."""
    return (
        labels.select(col(id_col).alias("doc_id"), col(label_col).cast("int").alias("toxic"))
        .filter("doc_id is not null and toxic in (0, 1)").filter(crc_mod("doc_id", FOLDS) != HELD_OUT)
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    )


def score(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted.

    Labels of the fold ``crc32(id) mod 4 = 2`` are not used. The lexicons are
    learned from at most ``LEXICON_TEXTS`` labelled texts of each class, the
    trees and their calibration from at most ``TREE_ROWS`` labelled rows; all
    texts are scored whole. Null counts as empty; empty texts get the score of
    their features (all zero). Repeated rows each get the same score, rows
    with a null id are scored and never held out by label. Without labels of
    both classes, or without texts for them, every score is the share of toxic labels (0 without
    any). An empty table gives an empty result; columns other than those named are not read.
    """
    return _score(docs, labels, id_col, text_col, label_col, Scratch(docs.sparkSession))


def _score(
    docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, work: Scratch, keys: tuple[str, ...] = ()
) -> DataFrame:
    spark = docs.sparkSession
    texts = docs.select(*keys, col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    known = work.table(_labels(labels, id_col, label_col), "labels")
    tally = known.agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("t")).first()
    held_out = (crc_mod("doc_id", FOLDS) == HELD_OUT).alias("held_out")
    prior = F.lit(float((tally.t or 0) / max(1, tally.n)))
    alike = texts.select(*keys, "doc_id", held_out, prior.alias("score"), _predicted(prior))
    if not tally.n or tally.t in (0, tally.n):
        return alike

    sample = [smallest_hashes(known.filter(F.col("toxic") == v), "doc_id", LEXICON_TEXTS, n) for v, n in ((0, tally.n - tally.t), (1, tally.t))]
    sample = work.table(sample[0].unionByName(sample[1]), "sample")
    lexicons = spark.sparkContext.broadcast(
        learn_lexicons(texts.join(F.broadcast(sample), "doc_id").select("text", "toxic"))
    )

    def features(batches):
        for batch in batches:
            rows = [_features(t, lexicons.value) for t in batch.column("text").to_pylist()]
            names = batch.schema.names[:-1]
            dense = pa.array(rows, pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*map(batch.column, names), dense], [*names, "features"])

    schema = StructType([*texts.schema.fields[:-1], StructField("features", ArrayType(DoubleType()))])
    dense = work.table(texts.mapInArrow(features, schema), "features")
    dense = dense.withColumn("features", array_to_vector("features"))

    rows = smallest_hashes(known, "doc_id", TREE_ROWS, tally.n).join(dense, "doc_id").select("doc_id", "toxic", "features")
    rows = work.table(rows.withColumn("fold", crc_mod("doc_id", FOLDS)), "rows").coalesce(6)
    if rows.select("toxic").distinct().count() < 2:
        return alike
    fitting = rows.filter(F.col("fold") != CALIBRATION)
    if fitting.select("toxic").distinct().count() < 2:
        fitting = rows
    trees = GBTClassifier(labelCol="toxic", maxIter=12, maxDepth=4, stepSize=0.3, seed=1).fit(fitting)
    raw = vector_to_array("probability")[1]
    isotonic = IsotonicRegression(featuresCol="raw", labelCol="toxic", predictionCol="calibrated").fit(
        trees.transform(rows.filter(F.col("fold") == CALIBRATION)).select(raw.alias("raw"), F.col("toxic").cast("double"))
        .unionByName(spark.createDataFrame([(0.0, 0.0), (1.0, 1.0)], "raw double, toxic double"))
    )
    scored = isotonic.transform(trees.transform(dense).select(*keys, "doc_id", raw.alias("raw")))
    # A calibration of steps ties many rows; a hundredth of the raw score keeps their order.
    value = F.least(F.lit(1.0), F.greatest(F.lit(0.0), 0.99 * F.col("calibrated") + 0.01 * F.col("raw")))
    return scored.select(*keys, "doc_id", held_out, value.alias("score"), _predicted(value))


def _predicted(value: Column) -> Column:
    return F.when(value >= THRESHOLD, 1).otherwise(0).alias("predicted")


def keep_clean(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not predicted to be toxic, with all their columns."""
    work = Scratch(docs.sparkSession)
    rows = located(docs, work)
    scored = _score(rows, labels, id_col, text_col, "toxic", work, (FILE, ROW))
    return without(rows, work.table(scored.filter("predicted = 1").select(FILE, ROW), "gone"))
