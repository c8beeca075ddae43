"""Near-duplicates by ProbMinHash, banding and exact verification.

The elements of a text are its shingles, weighted by how often they occur.
Each element sends arrivals of a Poisson process with its weight as rate to
random registers; a register keeps its first arrival. Arrivals later than the
latest of all registers change nothing, which ends the work early. The share
of registers in which two texts agree estimates their probability Jaccard
similarity. Texts that agree in a whole band of registers are candidates.

Equal texts are put together first. Links are then found in two steps. In each
bucket all texts are compared with one leader, the text that meets most others
over all its buckets; this is linear in a bucket's size and joins most groups
of copies. Only buckets that still hold several classes go on: there each two
texts of different classes are compared, block by block, inside the tasks; a
block returns only links that join classes. No list of pairs is ever made.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField, StructType

from cinetally.llm.common import FILE, ROW, col, located, maybe_members, membership_bits, text_of, without, worker_cache
from cinetally.llm.shingles import shingle_arrays
from cinetally.sources.scratch import Scratch

WORDS, THRESHOLD = 5, 0.8
#: A pair of similarity 0.8 shares a band with probability 1 - (1 - 0.8**6)**32 = 0.99994.
BANDS, BAND_REGISTERS = 32, 6
REGISTERS = BANDS * BAND_REGISTERS
#: Estimates below are not verified: 0.8 less five standard deviations.
DOUBTFUL = THRESHOLD - 5 * (THRESHOLD * (1 - THRESHOLD) / REGISTERS) ** 0.5
#: Texts of a bucket that one task compares at once.
BLOCK = 1_000
#: Texts that are signed at once, and their shingles.
SIGNED, SIGNED_SHINGLES = 1_000, 1 << 18
_GOLDEN, _M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mixed(x: np.ndarray) -> np.ndarray:
    """The finaliser of the splitmix64 generator (fixed constants)."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def _weighted(lengths: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, shingle, weight) of the distinct shingles, from all shingles of several texts."""
    text = np.repeat(np.arange(len(lengths)), lengths)
    order = np.lexsort((values, text))
    text, values = text[order], values[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (text[1:] != text[:-1])
    at = np.flatnonzero(new)
    return text[at], values[at], np.diff(np.append(at, len(values))).astype(np.float64)


def signatures(lengths: np.ndarray, values: np.ndarray, registers: int = REGISTERS) -> np.ndarray:
    """A row of registers per text: the element that arrived first in each, 0 for texts without any."""
    text, element, weight = _weighted(lengths, values.astype(np.uint64))
    first = np.full(len(lengths) * registers, np.inf)
    owner = np.zeros(len(lengths) * registers, np.uint64)
    time = np.zeros(len(element))
    step = np.uint64(0)
    with np.errstate(over="ignore"):
        while len(element):
            step += np.uint64(1)
            random = _mixed(element + step * _GOLDEN)
            again = _mixed(random ^ _GOLDEN)
            time = time - np.log((again >> np.uint64(11)).astype(np.float64) * 2.0**-53 + 2.0**-54) / weight
            register = ((random >> np.uint64(32)) * np.uint64(registers)) >> np.uint64(32)
            place = text * registers + register.astype(np.int64)
            np.minimum.at(first, place, time)
            won = first[place] == time
            owner[place[won]] = element[won]
            latest = first.reshape(-1, registers).max(axis=1)
            active = time < latest[text]
            text, element, weight, time = text[active], element[active], weight[active], time[active]
    return owner.reshape(-1, registers)


def _bands(owners: np.ndarray) -> np.ndarray:
    """A 64-bit key per band."""
    with np.errstate(over="ignore"):
        grouped = owners.reshape(len(owners), BANDS, BAND_REGISTERS)
        key = np.tile(np.arange(1, BANDS + 1, dtype=np.uint64) * _GOLDEN, (len(owners), 1))
        for i in range(BAND_REGISTERS):
            key = _mixed(key * _M1 + grouped[:, :, i])
        return key.view(np.int64)


Multiset = tuple[np.ndarray, np.ndarray]


def multiset(shingles: np.ndarray) -> Multiset:
    """The distinct shingles in order, and how often each occurs."""
    elements, weights = np.unique(shingles, return_counts=True)
    return elements, weights.astype(np.float64)


def similarity(a: Multiset, b: Multiset) -> float:
    """Probability Jaccard similarity."""
    (ea, wa), (eb, wb) = a, b
    if not len(ea) or not len(eb):
        return 0.0
    at = np.minimum(np.searchsorted(eb, ea), len(eb) - 1)
    shared = eb[at] == ea
    x, y = wa[shared], wb[at[shared]]
    if wa[wa.argmax()] == 1 and wb[wb.argmax()] == 1:
        return len(x) / (len(ea) + len(eb) - len(x))
    only_a, only_b = wa.sum() - x.sum(), wb.sum() - y.sum()
    total = 0.0
    for (p, q), n in zip(*np.unique(np.stack([x, y], 1), axis=0, return_counts=True), strict=True):
        total += n / (np.maximum(x / p, y / q).sum() + only_a / p + only_b / q)
    return float(total)


def _lists(column) -> tuple[np.ndarray, np.ndarray]:
    return np.diff(column.offsets.to_numpy()), column.flatten().to_numpy()


def _sign(batches):
    worker_cache("near_dedup")  # lets go of what another stage remembered
    for batch in batches:
        sizes, end = np.cumsum(np.diff(batch.column("shingles").offsets.to_numpy())), 0
        while end < batch.num_rows:
            start = end
            most = int(np.searchsorted(sizes, (sizes[start - 1] if start else 0) + SIGNED_SHINGLES, "right"))
            end = max(start + 1, min(most, start + SIGNED, batch.num_rows))
            part = batch.slice(start, end - start)
            owners = signatures(*_lists(part.column("shingles")))
            keys = _bands(owners)
            # 32 bits of each register are enough to estimate by.
            short = (owners >> np.uint64(32)).astype(np.uint32)
            offsets = pa.array(np.arange(len(keys) + 1, dtype=np.int32) * BANDS)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("digest"), part.column("first"), pa.ListArray.from_arrays(offsets, pa.array(keys.ravel())),
                    pa.array([row.tobytes() for row in short], pa.binary()),
                ],
                ["digest", "first", "bands", "signature"],
            )


def _verified(batches):
    """Of pairs (a, b, shingles of a, shingles of b) those that are similar enough."""
    for batch in batches:
        left, right = batch.column("left"), batch.column("right")
        same = [
            similarity(multiset(left[i].values.to_numpy()), multiset(right[i].values.to_numpy())) >= THRESHOLD - 1e-9
            for i in range(batch.num_rows)
        ]
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(same, pa.bool_()))


def _root(parent: dict, node):
    while parent.setdefault(node, node) != node:
        parent[node] = node = parent[parent[node]]
    return node


def _links_in_block(band: int, nodes, classes, chunks, signatures_, texts):
    """Links that join classes, of a block whose rows are of one chunk or of two.

    Two texts that share several bands are compared in the first of these only.
    """
    order = np.argsort(classes, kind="stable")
    parent: dict = {}
    crossing = len(set(chunks)) > 1
    for at, i in enumerate(order[:-1]):
        rest = order[at + 1 :]
        rest = rest[classes[rest] != classes[i]]
        if crossing:
            rest = rest[chunks[rest] != chunks[i]]
        if not len(rest):
            continue
        agree = signatures_[rest] == signatures_[i]
        estimate = agree.mean(axis=1)
        here = agree[:, : (band + 1) * BAND_REGISTERS].reshape(len(rest), band + 1, BAND_REGISTERS).all(axis=2).argmax(axis=1) == band
        close = (estimate >= DOUBTFUL) & here
        for j in rest[close][np.argsort(-estimate[close], kind="stable")]:
            a, b = _root(parent, classes[i]), _root(parent, classes[j])
            if a != b and similarity(texts[i], texts[j]) >= THRESHOLD - 1e-9:
                parent[a] = b
                yield nodes[i], nodes[j]


def _block_links(batches):
    """Links of all blocks of a task, whose rows come sorted by block."""
    held, key = [], None

    def finish(rows):
        if len({r[1] for r in rows}) > 1:
            yield from _links_in_block(
                key[1], [r[0] for r in rows], np.array([r[1] for r in rows]), np.array([r[2] for r in rows]),
                np.stack([np.frombuffer(r[3], np.uint32) for r in rows]), [r[4] for r in rows],
            )

    def packed(links):
        pairs = list(links)
        return pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.int64()) for k in (0, 1)], ["a", "b"])

    for batch in batches:
        columns = [batch.column(n).to_pylist() for n in ("bucket", "band", "low", "high", "node", "class", "chunk", "signature")]
        shingles = batch.column("shingles")
        for i, (*cell, node, kind, chunk, signature) in enumerate(zip(*columns, strict=True)):
            if cell != key:
                if held:
                    yield packed(finish(held))
                held, key = [], cell
            held.append((node, kind, chunk, signature, multiset(shingles[i].values.to_numpy())))
    if held:
        yield packed(finish(held))


def components(links: DataFrame, work: Scratch) -> DataFrame:
    """(node, class) of all nodes in links (a, b): the smallest node that they are connected with.

    Alternating large and small stars: a node's edges go over to its smallest
    neighbour. Sums and joins only, so a node with very many links is no list.
    """
    edges = work.table(
        links.filter("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges"
    )
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = work.table(large, "large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(least, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        edges = work.table(moved.select("e.u", "e.v").filter("u != v").distinct(), "edges")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    return work.table(
        edges.select(F.col("u").alias("node"), F.col("v").alias("class")).unionByName(
            edges.select(F.col("v").alias("node"), F.col("v").alias("class")).distinct()
        ),
        "classes",
    )


class _Search:
    def __init__(self, rows: DataFrame, work: Scratch) -> None:
        """``rows``: doc_id, file, row, text."""
        self.work = work
        first = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"), F.col(FILE).alias("file"), F.col(ROW).alias("row"))
        self.rows = shingle_arrays(rows.select(first.alias("first"), "text"), "first", size=WORDS)
        signed = self.rows.mapInArrow(
            _sign,
            StructType([
                StructField("digest", BinaryType()), self.rows.schema["first"],
                StructField("bands", ArrayType(LongType())), StructField("signature", BinaryType()),
            ]),
        )
        self.signed = work.table(signed, "signed")
        texts = self.signed.groupBy("digest").agg(
            F.min("first").alias("head"), F.any_value("bands").alias("bands"), F.any_value("signature").alias("signature")
        )
        # Written, so that the numbers stay.
        self.texts = work.table(texts.withColumn("node", F.monotonically_increasing_id()), "texts")

    def links(self) -> DataFrame:
        """Verified links (a, b) that connect the classes."""
        work = self.work
        # A text without shingles has a signature of zeros, and is like no other.
        banded = self.texts.filter(F.col("signature") != F.lit(bytes(4 * REGISTERS))).select("node", F.posexplode("bands").alias("band", "bucket"))
        sizes = work.table(banded.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).filter("size > 1"), "sizes")
        members = maybe_members(banded, F.col("bucket"), membership_bits(sizes, F.col("bucket"))).join(sizes, "bucket")
        members = work.table(members, "members")
        met = members.groupBy("node").agg(F.sum("size").alias("met"))
        leaders = members.join(met, "node").groupBy("bucket").agg(F.max(F.struct("met", (-F.col("node")).alias("n"))).alias("best"))
        leaders = leaders.select("bucket", (-F.col("best.n")).alias("leader"))
        pairs = work.table(
            members.join(leaders, "bucket").filter("node != leader").select(F.col("node").alias("a"), F.col("leader").alias("b")).distinct(), "pairs"
        )

        place = F.col("first")
        heads = self.texts.join(members.select("node").distinct(), "node", "left_semi").select("node", F.col("head").alias("first"), "signature")
        heads = work.table(heads, "heads")
        arrays = maybe_members(self.rows, place, membership_bits(heads, place)).select("first", "shingles").join(heads, "first")
        arrays = work.table(arrays.select("node", "signature", "shingles"), "arrays")

        near = pairs.join(self.texts.select(F.col("node").alias("a"), F.col("signature").alias("sa")), "a")
        near = near.join(self.texts.select(F.col("node").alias("b"), F.col("signature").alias("sb")), "b")
        near = near.mapInArrow(_close, "a bigint, b bigint")
        both = near.join(arrays.select(F.col("node").alias("a"), F.col("shingles").alias("left")), "a")
        both = both.join(arrays.select(F.col("node").alias("b"), F.col("shingles").alias("right")), "b")
        star = work.table(both.select("a", "b", "left", "right").mapInArrow(_verified, "a bigint, b bigint"), "star")

        classes = components(star, work)
        named = members.join(classes, "node", "left").withColumn("class", F.coalesce("class", "node"))
        named = work.table(named, "named")
        mixed = named.groupBy("bucket").agg(F.min("class").alias("low"), F.max("class").alias("high")).filter("low != high")
        # A large bucket is dealt out to cells of two chunks at most.
        chunks = F.ceil(F.col("size") / BLOCK).cast("int")
        rest = named.join(mixed.select("bucket"), "bucket", "left_semi").withColumn("chunk", F.pmod(F.xxhash64("node"), chunks).cast("int"))
        rest = rest.withColumn("other", F.explode(F.sequence(F.lit(0), chunks - 1)))
        rest = rest.select("bucket", "band", F.least("chunk", "other").alias("low"), F.greatest("chunk", "other").alias("high"), "node", "class", "chunk")
        rest = rest.join(arrays, "node")
        cells = rest.repartition("bucket", "low", "high").sortWithinPartitions("bucket", "low", "high")
        found = work.table(cells.mapInArrow(_block_links, "a bigint, b bigint"), "found")
        return star.unionByName(found)

    def classes(self) -> DataFrame:
        """(first, head) of every row: the place of the row and of the head of its class."""
        grouped = components(self.links(), self.work)
        texts = self.texts.select("digest", "node", "head").join(grouped, "node", "left").withColumn("class", F.coalesce("class", "node"))
        texts = self.work.table(texts, "classed")
        heads = texts.groupBy("class").agg(F.min("head").alias("class_head"))
        return self.signed.select("digest", "first").join(texts.join(heads, "class").select("digest", "class_head"), "digest").drop("digest")


def _close(batches):
    for batch in batches:
        if not batch.num_rows:
            continue
        a, b = (np.stack([np.frombuffer(s, np.uint32) for s in batch.column(n).to_pylist()]) for n in ("sa", "sb"))
        close = (a == b).mean(axis=1) >= DOUBTFUL
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(close))


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, class_id, kept.

    Texts are compared as lower-case words without ASCII punctuation. Texts
    with the same words are in one class, and so are texts whose shingles of
    five words have a probability Jaccard similarity of 0.8 or more, directly or
    over others. Texts of fewer words are one shingle; texts without words
    (null, empty) form one class. ``class_id`` is the smallest id of the class;
    its row stays (null ids come last, equal ids by place). An empty table
    gives an empty result; other columns are not read.
    """
    work = Scratch(docs.sparkSession)
    rows = located(docs.select(col(id_col).alias("doc_id"), text_of(text_col).alias("text")), work)
    found = _Search(rows, work).classes()
    return found.select(
        F.col("first.id").alias("doc_id"), F.col("class_head.id").alias("class_id"), (F.col("first") == F.col("class_head")).alias("kept")
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, one of each class, with all their columns."""
    work = Scratch(docs.sparkSession)
    rows = located(docs, work)
    texts = rows.select(col(id_col).alias("doc_id"), FILE, ROW, text_of(text_col).alias("text"))
    gone = _Search(texts, work).classes().filter("first != class_head")
    return without(rows, work.table(gone.select(F.col("first.file").alias(FILE), F.col("first.row").alias(ROW)), "gone"))
