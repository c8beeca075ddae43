"""Text quality by votes of the nearest labelled texts in a latent-semantic space.

Texts become hashed counts of words and of word shapes, weighted by inverse
document frequency over all texts, and are projected on the leading singular
vectors of labelled texts. These come from all products of the texts with each
other where they are few, else from a block Krylov space that grows until its
residuals vanish, which needs a small part of the memory. The labelled vectors are broadcast, in a bounded
number; the exact cosines with all of them are computed block by block.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, FloatType, IntegerType, StructField, StructType

from cinetally.llm.common import col, crc_mod, smallest_hashes, text_of, worker_cache
from cinetally.sources.scratch import Scratch

FOLDS, HELD_OUT = 3, 1
THRESHOLD = 0.5
#: Labelled texts of each class that vote, and nearest ones that are asked.
VOTERS, NEIGHBOURS = 2_000, 25
BUCKETS, SHAPES, TOPICS = 4_096, 256, 64
#: Weight of shapes against words, and of neighbours by similarity to this power.
SHAPE_WEIGHT, SHARPNESS = 3.0, 8
BLOCK = 2_048
#: Voters up to which all their products with each other are held; with more, rows that are dense at once.
ALL_PRODUCTS, DENSE = 1_024, 256
#: Vectors of a block of the Krylov space, and shares of the largest value that count as no residual and as no direction.
KRYLOV, RESIDUAL, NOISE = 32, 1e-7, 1e-11
CACHED = 300_000
#: Longer words are cut into runs of one kind, and longer runs into all stretches of GRAM characters.
WORD_CHARS, GRAM = 64, 4
#: Scripts that are written without spaces: Thai, Lao, Tibetan, Burmese, Khmer, kana, Han. Cut into stretches of two.
_SCRIPTS = "\u0e00-\u0fff\u1000-\u109f\u1780-\u17ff\u3005-\u3007\u3040-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff"
_UNSPACED = re.compile(f"[{_SCRIPTS}]")
_KINDS = re.compile(rf"[{_SCRIPTS}]+|(?:(?![{_SCRIPTS}])[^\W\d_])+|\d+|_+|(?:(?![{_SCRIPTS}])[^\w\s])+")

_RUNS = (
    (re.compile(r"[A-Z]{2,}"), "A"), (re.compile(r"[A-Z]"), "B"), (re.compile(r"[^\W\d_]+"), "a"),
    (re.compile(r"[0-9]+"), "0"), (re.compile(r"([^\w\s])\1+"), r"\1\1"),
)


def _terms(word: str) -> tuple[int, int]:
    """Buckets of the word itself, and of its shape: the kinds of its runs of characters."""
    shape = word
    for pattern, sign in _RUNS:
        shape = pattern.sub(sign, shape)
    core = word.lower().strip(".,;:!?\"'()[]")
    return (
        xxhash.xxh32_intdigest(core.encode("utf-8", "surrogatepass")) % (BUCKETS - SHAPES),
        BUCKETS - SHAPES + xxhash.xxh32_intdigest(shape.encode("utf-8", "surrogatepass")) % (SHAPES - 1),
    )


def _grams(run: str, size: int):
    return (run[i : i + size] for i in range(max(1, len(run) - size + 1)))


def _cut(word: str):
    """What is counted of a word: itself, or what it is cut into."""
    if len(word) <= WORD_CHARS and not _UNSPACED.search(word):
        yield word
        return
    for run in _KINDS.findall(word):
        if _UNSPACED.match(run):
            yield from _grams(run, 2)
        elif len(run) > WORD_CHARS:
            yield from _grams(run, GRAM)
        else:
            yield run


def _counts(text: str) -> tuple[list[int], list[float]]:
    """Damped counts by bucket; the last bucket holds the share of words that repeat the one before."""
    known = worker_cache("quality")
    if len(known) > CACHED:
        known.clear()
    words = text.split()
    if max(map(len, words), default=0) > WORD_CHARS or not text.isascii() and _UNSPACED.search(text):
        words = [piece for word in words for piece in _cut(word)]
    total: dict[int, float] = {}
    for word, n in Counter(words).items():
        pair = known.get(word)
        if pair is None:
            pair = known[word] = _terms(word)
        for bucket in pair:
            total[bucket] = total.get(bucket, 0) + n
    values = [float(np.log1p(v)) if b < BUCKETS - SHAPES else SHAPE_WEIGHT * v**0.5 for b, v in total.items()]
    repeats = sum(map(str.__eq__, words, words[1:]))
    if repeats:
        total[BUCKETS - 1] = repeats
        values.append(SHAPE_WEIGHT * repeats**0.5)
    return list(total), values


def _dense(indices: pa.ListArray, values: pa.ListArray) -> np.ndarray:
    rows = np.zeros((len(indices), BUCKETS), np.float32)
    at = np.repeat(np.arange(len(indices)), np.diff(indices.offsets.to_numpy()))
    rows[at, indices.flatten().to_numpy()] = values.flatten().to_numpy()
    return rows


def _unit(rows: np.ndarray) -> np.ndarray:
    norms = np.sqrt((rows * rows).sum(axis=1, keepdims=True))
    return rows / np.where(norms > 0, norms, 1)


def leading(blocks: Callable[[], Iterable[np.ndarray]], width: int, wanted: int) -> np.ndarray:
    """The leading right singular vectors, as columns, of the rows that ``blocks`` gives block by block.

    A block Krylov space grows until all wanted ones are settled or it holds whatever the rows span. Fewer come
    back where that is less.
    """

    def squared(vectors: np.ndarray) -> np.ndarray:
        found = np.zeros_like(vectors)
        for rows in blocks():
            rows = rows.astype(np.float64)
            found += rows.T @ (rows @ vectors)
        return found

    block = np.linalg.qr(np.random.default_rng(1).standard_normal((width, KRYLOV)))[0]
    space, inner = np.empty((width, 0)), np.empty((0, 0))
    while True:
        image = squared(block)
        space = np.hstack([space, block])
        held, new = space.shape[1], block.shape[1]
        part = space.T @ image
        inner = np.block([[inner, part[: held - new]], [part[: held - new].T, (part[held - new :] + part[held - new :].T) / 2]])
        rest, heights = np.linalg.qr(image - space @ part)
        # What the space holds already leaves rounding errors, which are no directions.
        rest = rest[:, np.abs(np.diag(heights)) > NOISE * np.abs(inner).max()]
        values, turn = np.linalg.eigh(inner)
        values, turn = values[::-1][:wanted], turn[:, ::-1][:, :wanted]
        left = np.sqrt(((heights @ turn[held - new :]) ** 2).sum(axis=0))
        if not rest.shape[1] or held >= wanted and left.max() <= RESIDUAL * values[0]:
            return space @ turn[:, values > RESIDUAL * values[0]]
        block = np.linalg.qr(rest - space @ (space.T @ rest))[0]


def score(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted.

    Labels of the fold ``crc32(id) mod 3 = 1`` are not used. At most ``VOTERS``
    labelled texts of each class span the space and vote; all texts are scored
    whole, with words that are very long or of an unspaced script cut into
    pieces. The score is the mean label of the ``NEIGHBOURS`` nearest voters,
    weighted by similarity and balanced for the size of the classes' samples.
    Texts without words (null, empty) are like no voter and get the score of
    all voters alike. Without labels of both classes, or without texts for them, every score is the share
    of positive labels (0.5 without any). Repeated rows each get the score of their text; rows with a null id
    are scored and do not vote. An empty table gives an empty result; columns other than those named are not read.
    """
    spark = docs.sparkSession
    work = Scratch(spark)
    texts = docs.select(col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    known = (
        labels.select(col(id_col).alias("doc_id"), col(label_col).cast("int").alias("label"))
        .filter("doc_id is not null and label in (0, 1)").filter(crc_mod("doc_id", FOLDS) != HELD_OUT)
        .groupBy("doc_id").agg(F.min("label").alias("label"))
    )
    known = work.table(known, "labels")
    tally = known.agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("good")).first()
    held_out = (crc_mod("doc_id", FOLDS) == HELD_OUT).alias("held_out")

    def result(rows: DataFrame, value) -> DataFrame:
        return rows.select("doc_id", held_out, value.alias("score"), (value >= THRESHOLD).cast("int").alias("predicted"))

    if not tally.n or tally.good in (0, tally.n):
        return result(texts, F.lit(tally.good / tally.n if tally.n else 0.5).cast("double"))

    def vectors(batches):
        for batch in batches:
            pairs = [_counts(t) for t in batch.column(1).to_pylist()]
            indices = pa.array([p[0] for p in pairs], pa.list_(pa.int32()))
            values = pa.array([p[1] for p in pairs], pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), indices, values], ["doc_id", "indices", "values"])

    doc_id = StructField("doc_id", texts.schema["doc_id"].dataType)
    schema = StructType([doc_id, StructField("indices", ArrayType(IntegerType())), StructField("values", ArrayType(FloatType()))])
    sparse = work.table(texts.mapInArrow(vectors, schema), "vectors")

    def frequencies(batches):
        seen, rows = np.zeros(BUCKETS, np.int64), 0
        for batch in batches:
            seen += np.bincount(batch.column(0).flatten().to_numpy(), minlength=BUCKETS)
            rows += batch.num_rows
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(-1, BUCKETS), pa.int32()), pa.array([rows, *seen.tolist()], pa.int64())], ["bucket", "n"]
        )

    # A fixed number of buckets, added up in each task first.
    seen = sparse.select("indices").mapInArrow(frequencies, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    seen = dict(map(tuple, seen.collect()))
    weights = np.array([np.log((1 + seen.get(-1, 0)) / (1 + seen.get(b, 0))) + 0.1 for b in range(BUCKETS)], np.float32)

    sampled = [smallest_hashes(known.filter(F.col("label") == v), "doc_id", VOTERS, n) for v, n in ((0, tally.n - tally.good), (1, tally.good))]
    # Of several texts with one id the one with the smallest features votes; voters are in the order of their ids.
    voters = sparse.join(F.broadcast(sampled[0].unionByName(sampled[1])), "doc_id")
    voters = voters.groupBy("doc_id").agg(F.min(F.struct("label", "indices", "values")).alias("v")).orderBy("doc_id")
    voters = voters.select("v.label", "v.indices", "v.values").toArrow().combine_chunks()
    label = voters.column("label").to_numpy().astype(np.float32)
    if len(set(label)) < 2:
        return result(texts, F.lit(tally.good / tally.n).cast("double"))
    indices, values = (voters.column(n).combine_chunks() for n in ("indices", "values"))
    at_once = len(label) if len(label) <= ALL_PRODUCTS else DENSE

    def weighted():
        for start in range(0, len(label), at_once):
            yield _unit(_dense(indices.slice(start, at_once), values.slice(start, at_once)) * weights)

    if len(label) <= ALL_PRODUCTS:
        (rows,) = weighted()
        # The leading right singular vectors, from the products of the rows with each other.
        _, axes = np.linalg.eigh(rows @ rows.T)
        basis = _unit(axes[:, ::-1][:, :TOPICS].T @ rows).T
    else:
        basis = leading(weighted, BUCKETS, TOPICS).astype(np.float32)
    anchors = np.concatenate([_unit(rows @ basis) for rows in weighted()])
    share = label.mean()
    balance = np.where(label == 1, 0.5 / share, 0.5 / (1 - share)).astype(np.float32)
    shared = spark.sparkContext.broadcast((weights[:, None] * basis, anchors, label, balance))

    def votes(batches):
        project, anchors, label, balance = shared.value
        k = min(NEIGHBOURS, len(label))
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK):
                part = batch.slice(start, BLOCK)
                rows = _dense(part.column(1), part.column(2))
                cosines = _unit(rows @ project) @ anchors.T
                best = np.argpartition(-cosines, k - 1, axis=1)[:, :k]
                weight = np.clip(np.take_along_axis(cosines, best, axis=1), 0, 1) ** SHARPNESS * balance[best]
                weight[rows.any(axis=1) == 0] = 0
                total = weight.sum(axis=1)
                prior = float((label * balance).sum() / balance.sum())
                good = np.where(total > 0, (weight * label[best]).sum(axis=1) / np.where(total > 0, total, 1), prior)
                score = pa.array(np.clip(good.astype(np.float64), 0, 1))
                yield pa.RecordBatch.from_arrays([part.column(0), score], ["doc_id", "score"])

    scored = sparse.mapInArrow(votes, f"doc_id {doc_id.dataType.simpleString()}, score double")
    return result(scored, F.col("score"))
