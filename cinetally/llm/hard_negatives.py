"""Hard negatives by rotated one-bit codes with exact integer scores.

Vectors of whole numbers are turned by one fixed random rotation. A vector keeps
the signs of its turned components, one bit each, its length, and how far it is
aligned with its code, the unit vector of those signs. For an anchor, whose
turned components are rounded to a few bits, population counts of bit planes
give its product with the code. What lies off the code on both sides is bounded
by Cauchy and Schwarz, so each product of anchor and vector has an interval that
is certain. The few vectors with the best estimates are scored first, in whole numbers; then those
whose interval still reaches the wanted scores, and nothing but these scores decides.

Vectors are dealt to chunks and anchors to blocks. A cell is one chunk with one
block; a task holds the vectors of a cell and lets the anchors pass by, each of
which leaves its few best vectors.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from cinetally.llm.common import col, worker_cache
from cinetally.sources.scratch import Scratch

POSITIVES, NEGATIVES = 5, 5
#: A negative scores at least this share of the positive, in percent, and no more than it.
LEAST_PERCENT = 80
#: Bytes of the vectors of a chunk, and anchors of a block, at most about so many.
CHUNK_BYTES, BLOCK = 1 << 24, 8_192
#: Vectors that are scored by their estimates alone, for each that is wanted.
FIRST = 4
#: Bits of an anchor's turned components.
ANCHOR_BITS = 6
_SEED = 20_011
#: Sums below are exact in doubles.
_EXACT = 2.0**53


def rotation(dims: int) -> np.ndarray:
    """The same random rotation in every worker."""
    cache = worker_cache("rotations")
    if dims not in cache:
        q, r = np.linalg.qr(np.random.default_rng(_SEED).standard_normal((dims, dims)))
        cache[dims] = q * np.sign(np.diag(r))
    return cache[dims]


def encode(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(codes as words of 64 bits, alignment with the code, length) of each row."""
    dims = vectors.shape[1]
    turned = vectors @ rotation(dims).T
    bits = np.zeros((len(vectors), -(-dims // 64) * 64), np.uint8)
    bits[:, :dims] = turned >= 0
    codes = np.packbits(bits, axis=1, bitorder="little").view(np.uint64)
    return codes, np.abs(turned).sum(axis=1) / np.sqrt(dims), np.sqrt((vectors * vectors).sum(axis=1))


def intervals(anchor: np.ndarray, codes: np.ndarray, align: np.ndarray, norm: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of the product of the anchor with each vector."""
    dims = len(anchor)
    turned = rotation(dims) @ anchor
    length = float(np.sqrt(anchor @ anchor))
    low, step = turned.min(), (turned.max() - turned.min()) / (2**ANCHOR_BITS - 1)
    units = np.rint((turned - low) / step).astype(np.int64) if step > 0 else np.zeros(dims, np.int64)
    rounded = low + step * units
    error = float(np.sqrt(((turned - rounded) ** 2).sum()))
    planes = np.zeros((ANCHOR_BITS, codes.shape[1] * 64), np.uint8)
    planes[:, :dims] = (units >> np.arange(ANCHOR_BITS)[:, None]) & 1
    planes = np.packbits(planes, axis=1, bitorder="little").view(np.uint64)
    weighted = sum(np.bitwise_count(codes & plane).sum(axis=1, dtype=np.int64) << k for k, plane in enumerate(planes))
    ones = np.bitwise_count(codes).sum(axis=1, dtype=np.int64)
    on_code = (2 * (low * ones + step * weighted) - rounded.sum()) / np.sqrt(dims)
    least = np.maximum(np.abs(on_code) - error, 0)
    off_code = np.sqrt(np.maximum(length**2 - least**2, 0)) * np.sqrt(np.maximum(norm**2 - align**2, 0))
    # The last part is far more than the rounding of doubles.
    half = align * error + off_code + 1e-9 * (length * norm + 1)
    return align * on_code - half, align * on_code + half


def products(anchor: np.ndarray, vectors: np.ndarray, norm: np.ndarray) -> list[int]:
    """Exact products of whole numbers."""
    if float(np.sqrt(anchor @ anchor)) * norm.max(initial=0.0) < _EXACT:
        return (vectors @ anchor).astype(np.int64).tolist()
    whole = [int(x) for x in anchor]
    return [sum(a * int(b) for a, b in zip(whole, row, strict=True)) for row in vectors]


class _Vectors:
    """The vectors of a cell."""

    def __init__(self, rows: list[dict]) -> None:
        self.node = np.array([r["node"] for r in rows])
        self.id = [r["id"] for r in rows]
        self.label = np.array([r["label"] for r in rows])
        self.vector = np.stack([np.frombuffer(r["vector"]) for r in rows])
        self.code = np.stack([np.frombuffer(r["code"], np.uint64) for r in rows])
        self.align, self.norm = (np.array([r[n] for r in rows]) for n in ("align", "norm"))

    def best(self, anchor: np.ndarray, low: np.ndarray, high: np.ndarray, among: np.ndarray, k: int, least=None, most=None):
        """The first k of the chosen vectors with a score from ``least`` to ``most``: (score, node, id)."""

        def scored(at: np.ndarray):
            for s, i in zip(products(anchor, self.vector[at], self.norm[at]), at.tolist(), strict=True):
                if least is None or least <= s <= most:
                    yield s, int(self.node[i]), self.id[i]

        at = np.flatnonzero(among)
        if least is not None:
            at = at[(high[at] >= least) & (low[at] <= most)]
        if len(at) > FIRST * k:
            estimate = (low[at] + high[at]) / 2
            if most is not None:
                estimate = most - np.abs(most - estimate)
            best = sorted((s for s, *_ in scored(at[np.argpartition(-estimate, FIRST * k)[: FIRST * k]])), reverse=True)
            if len(best) >= k:
                at = at[high[at] >= best[k - 1]]
        found = list(scored(at))
        found.sort(key=lambda f: (-f[0], f[2] is None, f[2] or 0, f[1]))
        return found[:k]


def _cells(rows_of_cell):
    """A function over the sorted rows of whole cells: ``rows_of_cell(vectors, anchor row)`` gives tuples."""

    def run(batches):
        key, held, vectors = None, [], None
        for batch in batches:
            found = []
            for row in batch.to_pylist():
                if (row["chunk"], row["block"]) != key:
                    key, held, vectors = (row["chunk"], row["block"]), [], None
                if not row["is_anchor"]:
                    held.append(row)
                elif held:
                    vectors = vectors or _Vectors(held)
                    found += rows_of_cell(vectors, row)
            columns = list(zip(*found, strict=True)) if found else [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["anchor", "wanted", "score", "node", "id"])

    return run


def _best_positives(vectors: _Vectors, row: dict):
    anchor = np.frombuffer(row["vector"])
    low, high = intervals(anchor, vectors.code, vectors.align, vectors.norm)
    among = (vectors.label == row["label"]) & (vectors.node != row["node"])
    for found in vectors.best(anchor, low, high, among, row["k"]):
        yield (row["node"], None, *found)


def _best_negatives(vectors: _Vectors, row: dict):
    anchor = np.frombuffer(row["vector"])
    low, high = intervals(anchor, vectors.code, vectors.align, vectors.norm)
    among = vectors.label != row["label"]
    for score in row["wanted"]:
        least = -(-row["percent"] * score // 100)
        if least <= score:
            for found in vectors.best(anchor, low, high, among, row["k"], least, score):
                yield (row["node"], score, *found)


class _Index:
    def __init__(self, rows: DataFrame, scale: int, work: Scratch) -> None:
        """``rows``: id, label, vector, is_anchor."""
        self.work = work
        finite = ~F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
        rows = rows.filter(F.col("label").isNotNull() & F.col("vector").isNotNull()).withColumn("vector", F.col("vector").cast("array<double>")).filter(finite)
        dims = max(1, rows.agg(F.max(F.size("vector"))).first()[0] or 0)

        def coded(batches):
            for batch in batches:
                for start in range(0, batch.num_rows, 2_000):
                    part = batch.slice(start, 2_000)
                    vectors = np.zeros((part.num_rows, dims))
                    for i, vector in enumerate(part.column("vector")):
                        vectors[i, : len(vector)] = np.floor(scale * vector.values.to_numpy())
                    codes, align, norm = encode(vectors)
                    yield pa.RecordBatch.from_arrays(
                        [
                            *(part.column(n) for n in ("id", "label", "is_anchor")), pa.array([v.tobytes() for v in vectors], pa.binary()),
                            pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(align), pa.array(norm),
                        ],
                        ["id", "label", "is_anchor", "vector", "code", "align", "norm"],
                    )

        schema = "id long, label string, is_anchor boolean, vector binary, code binary, align double, norm double"
        found = rows.select("id", "label", "is_anchor", "vector").mapInArrow(coded, schema)
        # Written, so that the numbers stay.
        self.rows = work.table(found.withColumn("node", F.monotonically_increasing_id()), "vectors")
        counts = self.rows.agg(F.count(F.lit(1)), F.count_if("is_anchor")).first()
        parallel = rows.sparkSession.sparkContext.defaultParallelism
        self.chunks, self.blocks = max(parallel, -(-counts[0] * dims * 8 // CHUNK_BYTES)), max(1, -(-counts[1] // BLOCK))

    def search(self, anchors: DataFrame, function, k: int) -> DataFrame:
        """The best of every cell, of which the best k of each anchor and wanted score: anchor, wanted, score, node, id, rank.

        ``anchors``: rows of the index with ``wanted``, a list of scores, and ``percent``.
        """

        def every(n: int) -> Column:
            return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

        def dealt(n: int) -> Column:
            return F.pmod(F.xxhash64("node"), F.lit(n)).cast("int")

        nothing = {"wanted": F.lit(None).cast("array<bigint>"), "percent": F.lit(None).cast("int"), "k": F.lit(None).cast("int")}
        held = self.rows.withColumns({"is_anchor": F.lit(False), **nothing, "chunk": dealt(self.chunks)}).withColumn("block", every(self.blocks))
        passing = anchors.withColumns({"is_anchor": F.lit(True), "k": F.lit(k), "block": dealt(self.blocks)}).withColumn("chunk", every(self.chunks))
        cells = held.unionByName(passing).repartition("chunk", "block").sortWithinPartitions("chunk", "block", "is_anchor")
        best = cells.mapInArrow(_cells(function), "anchor long, wanted long, score long, node long, id long")
        order = Window.partitionBy("anchor", "wanted").orderBy(F.desc("score"), F.asc_nulls_last("id"), F.asc("node"))
        return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def mine(
    vectors: DataFrame,
    is_anchor: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    *,
    scale: int = 256,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    least_percent: int = LEAST_PERCENT,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Components become floor(scale * x); a score is the whole-number product of
    two vectors (an error if it does not fit 64 bits). An anchor, a row for which ``is_anchor`` is true, has as
    positives its best other rows of the same label. For each, the best rows
    of other labels follow whose score is from ``least_percent`` to 100
    percent of the positive's; there are none if that score is negative.
    Ties go to the smaller id, null ids last, repeated ids in a fixed order.

    Rows with a null label, a null vector, or a null or non-finite component take no part. Rows
    are told apart by more than their id, so a repeated id is another row. Shorter vectors (empty ones too)
    count as ended by zeros; the rotation has as many rows and columns as the longest has components. An empty table, or one without anchors, gives an empty result;
    columns other than those named and those of ``is_anchor`` are not read.
    """
    work = Scratch(vectors.sparkSession)
    rows = vectors.select(
        col(id_col).cast("bigint").alias("id"), col(label_col).cast("string").alias("label"), col(vector_col).alias("vector"),
        F.coalesce(is_anchor, F.lit(False)).alias("is_anchor"),
    )
    index = _Index(rows, scale, work)
    anchors = index.rows.filter("is_anchor").withColumns({"wanted": F.lit(None).cast("array<bigint>"), "percent": F.lit(least_percent)})
    best = index.search(anchors, _best_positives, positives)
    best = work.table(best.select("anchor", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    # As many scores as an anchor has positives.
    wanted = best.groupBy("anchor").agg(F.collect_set("positive_score").alias("wanted"))
    asked = anchors.drop("wanted").join(wanted, F.col("node") == F.col("anchor")).drop("anchor")
    found = index.search(asked, _best_negatives, negatives)
    found = found.select("anchor", F.col("wanted").alias("positive_score"), "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    named = best.join(index.rows.filter("is_anchor").select(F.col("node").alias("anchor"), F.col("id").alias("anchor_id")), "anchor")
    return named.join(found, ["anchor", "positive_score"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
