"""Exact Jaccard join of word n-grams by grouped prefixes.

A text is the set of its distinct n-grams, as hashes of 64 bits. Sets are put in
one order for all texts, rarest first: by how often the bucket of a hash occurs
in all texts (a bounded table of counts over every text), then by the hash. Two
sets that are similar enough share one of their first elements, the prefix.
Equal sets are put together; sets with the same prefix and size form a group.
Groups that share a prefix element are paired, and pairs go by their sizes and
by the places of the shared element before any member is looked at.

Links are found in two steps. Over the groups of an element all go with one leader, the
group that meets most others; their members are verified, and classes made of the
links. This is linear in the number of groups and settles most copies. Elements
whose groups still lie in several classes are expanded to their members, which are
compared in blocks inside the tasks, where a pair must also pass a parity bitmap: two
bitmaps never differ in more bits than the sets in elements, so a pair that fails
is not similar. Of a small block all pairs that pass are verified; of a large one as many as
would join its classes, and the block is gone through again without those that failed,
unless they came together over others.
"""

from __future__ import annotations

import hashlib
import itertools
import math
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, functions as F

from cinetally.llm.common import FILE, ROW, col, located, maybe_members, membership_bits, surely_others, text_of
from cinetally.llm.near_dedup import components
from cinetally.sources.scratch import Scratch

WORDS, PERCENT = 4, 85
#: Hashes are counted in so many buckets (2**BUCKET_BITS), moved in so many parts.
BUCKET_BITS, PARTS = 24, 16
#: Bits of a bitmap: the power of two from so many per element on, and at least. Small blocks take it folded to the last
#: number; in large ones a pair that passes and fails costs another round.
BITS_EACH, LEAST_BITS, BLOCK_BITS = 4, 512, 1024
#: Rows of a block, and of those whose pairs are all verified.
BLOCK, SMALL = 2_000, 32
#: Elements with more members than so many blocks are cut by size as well; a chunk's number is its band's times _BAND, and on.
BANDED, _BAND = 3, 1 << 32
#: Octets that are hashed, or texts' octets that are taken, at once.
OCTETS = 1 << 20
_GOLDEN, _M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)


def _mixed(x: np.ndarray) -> np.ndarray:
    """The finaliser of the splitmix64 generator (fixed constants)."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def word_hashes(octets: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words of each text, and the hashes of all words in order, from the octets of several texts."""
    inside = ~_WHITE[octets]
    start = inside.copy()
    start[1:] &= ~inside[:-1]
    borders = offsets[:-1][offsets[:-1] < len(octets)]
    start[borders] |= inside[borders]
    at = np.flatnonzero(start)
    counts = np.diff(np.searchsorted(at, offsets))
    hashes = np.empty(len(at), np.uint64)
    done = 0
    while done < len(at):
        until = max(done + 1, int(np.searchsorted(at, at[done] + OCTETS)))
        low, high = at[done], at[until] if until < len(at) else len(octets)
        place = np.flatnonzero(inside[low:high])
        first = np.searchsorted(place, at[done:until] - low)
        lengths = np.diff(np.append(first, len(place)))
        with np.errstate(over="ignore"):
            within = (np.arange(len(place)) - np.repeat(first, lengths)).astype(np.uint64)
            value = _mixed(_LOWER[octets[low:high][place]] * _M1 + (within + np.uint64(1)) * _GOLDEN)
            hashes[done:until] = _mixed(np.add.reduceat(value, first) + lengths.astype(np.uint64) * _M2)
        done = until
    return counts, hashes


def gram_sets(counts: np.ndarray, hashes: np.ndarray, words: int = WORDS) -> list[np.ndarray]:
    """Per text its distinct n-grams in order; all its words as one where there are fewer, nothing without words."""
    with np.errstate(over="ignore"):
        chains = [_mixed(hashes + _GOLDEN)]
        for k in range(1, words):
            chains.append(_mixed(chains[-1][: len(hashes) - k] * _M1 + hashes[k:]))
    sets, begin = [], 0
    for count in counts.tolist():
        grams = chains[min(count, words) - 1][begin : begin + max(1, count - words + 1)] if count else hashes[:0]
        grams = np.sort(grams.view(np.int64))
        sets.append(grams[np.append(True, grams[1:] != grams[:-1])] if len(grams) else grams)
        begin += count
    return sets


def _sets(batch: pa.RecordBatch, words: int):
    """(rows, their sets) of slices of a batch with about ``OCTETS`` of text."""
    text = batch.column("text").cast(pa.large_string())
    sizes = np.cumsum(pa.compute.binary_length(text).to_numpy())
    begin = 0
    while begin < batch.num_rows:
        used = sizes[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(sizes, used + OCTETS)))
        part = text.slice(begin, end - begin)
        offsets = np.frombuffer(part.buffers()[1], np.int64)[part.offset : part.offset + len(part) + 1]
        data = part.buffers()[2]
        octets = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data else np.empty(0, np.uint8)
        yield batch.slice(begin, end - begin), gram_sets(*word_hashes(octets, offsets - offsets[0]), words)
        begin = end


def _buckets(grams: np.ndarray) -> np.ndarray:
    return (grams.view(np.uint64) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def least_shared(size: int, percent: int) -> int:
    """Elements of a set that any similar one has, at least."""
    return -(-percent * size // 100)


def prefix(grams: np.ndarray, common: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """The first elements in the order of all texts, as many as cannot all be missing from a similar set."""
    order = np.lexsort((grams, common[_buckets(grams)]))
    return grams[order[: len(grams) - least_shared(len(grams), percent) + 1]]


def bitmap(grams: np.ndarray, most: int | None = None) -> bytes:
    """Whether an even or odd number of elements falls on each bit. Equal elements cancel out between two bitmaps."""
    bits = max(LEAST_BITS, 1 << (BITS_EACH * max(1, len(grams)) - 1).bit_length())
    bits = min(bits, most or bits)
    return np.packbits(np.bincount(grams & (bits - 1), minlength=bits).astype(np.uint8) & 1).tobytes()


class Bitmaps:
    """Bitmaps of several widths. Of two, one of twice the bits is folded to the other's."""

    def __init__(self, raw: list[bytes]) -> None:
        self.width = np.array([len(r) for r in raw], np.int64)
        self.rows: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for width in np.unique(self.width).tolist():
            own, wide = np.flatnonzero(self.width == width), np.flatnonzero(self.width == 2 * width)
            words = np.frombuffer(b"".join([raw[i] for i in own]), np.uint64).reshape(len(own), -1)
            halves = np.frombuffer(b"".join([raw[i] for i in wide]), np.uint64).reshape(len(wide), 2, words.shape[1])
            index = np.full(len(raw), -1)
            index[np.concatenate([own, wide])] = np.arange(len(own) + len(wide))
            self.rows[width] = index, np.concatenate([words, halves[:, 0] ^ halves[:, 1]])

    def differing(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Differing bits of pairs of rows, whose widths are one doubling apart at most."""
        narrow = np.minimum(self.width[a], self.width[b])
        found = np.zeros(len(a), np.int64)
        for width in np.unique(narrow).tolist():
            index, words = self.rows[width]
            at = np.flatnonzero(narrow == width)
            for part in np.array_split(at, max(1, len(at) * width >> 22)):
                found[part] = np.bitwise_count(words[index[a[part]]] ^ words[index[b[part]]]).sum(axis=1, dtype=np.int64)
        return found


def _parts(counts: np.ndarray):
    """The counts in parts (part, octets, places, rest): where few are not zero only these, else an octet each and what goes beyond it."""
    for part, own in enumerate(counts.reshape(PARTS, -1)):
        few = 8 * np.count_nonzero(own) < len(own)
        octets = b"" if few else zlib.compress(np.minimum(own, 255).astype(np.uint8).tobytes(), 1)
        rest = own if few else own - np.minimum(own, 255)
        at = np.flatnonzero(rest)
        yield {"part": part, "octets": octets, "places": at.astype(np.uint32).tobytes(), "rest": rest[at].tobytes()}


def _common(texts: DataFrame, words: int) -> np.ndarray:
    """How common the n-grams of each bucket are over all texts, in sixteenths of a doubling: 2**BUCKET_BITS octets, however many the texts."""

    def counted(batches):
        counts = np.zeros(1 << BUCKET_BITS, np.uint32)
        for batch in batches:
            for _, sets in _sets(batch, words):
                bucket, n = np.unique(_buckets(np.concatenate(sets)), return_counts=True)
                counts[bucket] += n.astype(np.uint32)
        for part in _parts(counts) if counts.any() else ():
            yield pa.RecordBatch.from_pylist([part])

    def added(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for row in batch.to_pylist():
                own = sums.setdefault(row["part"], np.zeros((1 << BUCKET_BITS) // PARTS))
                if row["octets"]:
                    own += np.frombuffer(zlib.decompress(row["octets"]), np.uint8)
                own[np.frombuffer(row["places"], np.uint32)] += np.frombuffer(row["rest"], np.uint32)
        for part, own in sums.items():
            steps = np.minimum(np.rint(16 * np.log2(1 + own)), 255).astype(np.uint8)
            yield pa.RecordBatch.from_pydict({"part": [part], "steps": pa.array([steps.tobytes()], pa.binary())})

    parts = texts.select("text").mapInArrow(counted, "part long, octets binary, places binary, rest binary").repartition(PARTS, "part")
    common = np.zeros((PARTS, (1 << BUCKET_BITS) // PARTS), np.uint8)
    for batch in parts.mapInArrow(added, "part long, steps binary").toArrow().to_batches():
        for part, steps in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            common[part] = np.frombuffer(steps.as_buffer(), np.uint8)
    return common.ravel()


def _may_link(size: np.ndarray, place: np.ndarray, bits: Bitmaps, a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Whether pairs of rows can be similar: by sizes, by what is left behind the shared element, by differing bits."""
    both, least = size[a] + size[b], 100 + percent
    close = 100 * np.minimum(size[a], size[b]) >= percent * np.maximum(size[a], size[b])
    close &= least * np.minimum(size[a] - place[a], size[b] - place[b]) >= percent * both
    at = np.flatnonzero(close)
    # Similar sets differ in both - 2 * shared elements, where least * shared >= percent * both.
    close[at] = least * bits.differing(a[at], b[at]) <= (100 - percent) * both[at]
    return close


class _Cells:
    """Rows of cells, sorted by cell, as arrays."""

    def __init__(self, rows: pa.Table, percent: int) -> None:
        columns = {n: rows.column(n).to_numpy() for n in ("gram", "low", "high", "node", "class", "size", "place", "chunk")}
        self.gram, self.node, self.kind, self.size, self.place, self.chunk = (columns[n] for n in ("gram", "node", "class", "size", "place", "chunk"))
        self.percent, self.crossing = percent, columns["low"] != columns["high"]
        self.bits = Bitmaps(rows.column("bits").to_pylist())
        self.failed = rows.column("failed").to_pylist()
        self.cell = np.cumsum(_new_cells(rows))

    def may_link(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        # A cell of two chunks leaves pairs inside one of them to that chunk's own cell.
        open_ = (self.chunk[a] != self.chunk[b]) | ~self.crossing[a]
        at = np.flatnonzero(open_)
        open_[at] = _may_link(self.size, self.place, self.bits, a[at], b[at], self.percent)
        return open_

    def small_pairs(self, sizes: np.ndarray):
        """All pairs that may link, of cells with up to SMALL rows."""
        small = np.repeat(sizes <= SMALL, sizes)
        for d in range(1, min(SMALL, int(sizes.max(initial=0)))):
            a = np.flatnonzero((self.cell[d:] == self.cell[:-d]) & small[d:] & (self.kind[d:] != self.kind[:-d]))
            a = a[self.may_link(a, a + d)]
            for i in a.tolist():
                yield int(self.node[i]), int(self.node[i + d]), None

    def joining_pairs(self, begin: int, end: int):
        """Pairs of a large cell that may link and would join its classes, with the cell's element."""
        kind = np.unique(self.kind[begin:end], return_inverse=True)[1]
        rows = np.arange(begin, end)
        # Rows are sorted by size; beyond the last one that is not too large none can link.
        last = np.searchsorted(self.size[begin:end], 100 * self.size[begin:end] // self.percent, "right")
        for i in rows[:-1]:
            rest = rows[i - begin + 1 : last[i - begin]]
            rest = rest[kind[rest - begin] != kind[i - begin]]
            rest = rest[self.may_link(np.full(len(rest), i), rest)]
            failed = set(self.failed[i] or ())
            for j in rest.tolist():
                if kind[j - begin] != kind[i - begin] and int(self.node[j]) not in failed:
                    kind[kind == kind[j - begin]] = kind[i - begin]
                    yield int(self.node[i]), int(self.node[j]), int(self.gram[i])


def _new_cells(rows: pa.Table) -> np.ndarray:
    """Whether a row begins a cell."""
    key = np.stack([rows.column(n).to_numpy() for n in ("gram", "low", "high")], axis=1)
    return np.append(np.ones(min(1, len(key)), bool), (key[1:] != key[:-1]).any(axis=1))


def _cell_pairs(percent: int):
    def run(batches):
        held: list[pa.RecordBatch] = []
        for batch in itertools.chain(batches, [None]):
            held += [batch] if batch is not None and batch.num_rows else []
            if not held or batch is not None and sum(b.num_rows for b in held) < 2 * BLOCK:
                continue
            rows = pa.Table.from_batches(held).combine_chunks()
            starts = np.flatnonzero(_new_cells(rows))
            # The last cell may go on in the next batch.
            whole = rows.num_rows if batch is None else int(starts[-1])
            held = rows.slice(whole).to_batches()
            if not whole:
                continue
            starts = starts[starts < whole]
            cells, sizes = _Cells(rows.slice(0, whole), percent), np.diff(np.append(starts, whole))
            pairs = list(cells.small_pairs(sizes))
            for begin, size in zip(starts[sizes > SMALL].tolist(), sizes[sizes > SMALL].tolist(), strict=True):
                pairs += cells.joining_pairs(begin, begin + size)
            yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.int64()) for k in range(3)], ["a", "b", "gram"])

    return run


def _digest(grams: np.ndarray, size: int = 0) -> bytes:
    return hashlib.blake2b(grams.tobytes(), digest_size=16, key=size.to_bytes(8, "little")).digest()


def _shared(a: np.ndarray, b: np.ndarray) -> int:
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    return int((b[at] == a).sum())


class _Join:
    def __init__(self, docs: DataFrame, work: Scratch, words: int, percent: int) -> None:
        """``docs``: doc_id, file, row, text."""
        self.work, self.docs, self.words, self.percent = work, docs, words, percent
        # Broadcast by itself: in the function it would be pickled with it, and unpickled by every task.
        common = docs.sparkSession.sparkContext.broadcast(_common(docs, words))

        def signed(batches):
            for batch in batches:
                for rows, sets in _sets(batch, words):
                    firsts = [prefix(s, common.value, percent) if len(s) else s for s in sets]
                    yield pa.RecordBatch.from_arrays(
                        [
                            *(rows.column(n) for n in ("doc_id", FILE, ROW)), pa.array([len(s) for s in sets], pa.int64()),
                            pa.array([_digest(s) for s in sets], pa.binary()),
                            pa.array([_digest(f, len(s)) for f, s in zip(firsts, sets, strict=True)], pa.binary()), pa.array(firsts, pa.list_(pa.int64())),
                            pa.array([bitmap(s) for s in sets], pa.binary()), pa.array([bitmap(s, BLOCK_BITS) for s in sets], pa.binary()),
                        ],
                        ["doc_id", FILE, ROW, "size", "digest", "group_key", "prefix", "bits", "block_bits"],
                    )

        schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {FILE} string, {ROW} long, size long, digest binary"
        schema += ", group_key binary, prefix array<long>, bits binary, block_bits binary"
        # Written, so that the numbers stay. Of equal texts the first number stands for all.
        self.signed = work.table(docs.mapInArrow(signed, schema).withColumn("node", F.monotonically_increasing_id()), "signed")
        common.destroy()
        texts = self.signed.filter("size > 0").groupBy("digest").agg(
            F.min("node").alias("node"), F.min("doc_id").alias("least_id"), F.any_value("group_key").alias("group_key")
        )
        self.texts = work.table(texts, "texts")

    def _signs(self, wanted: DataFrame) -> DataFrame:
        """The rows, less most of those that are not among the nodes; their signs are the bulk of what is shuffled."""
        return maybe_members(self.signed, F.col("node"), membership_bits(wanted, F.col("node")))

    def _prefixes(self, groups: DataFrame) -> DataFrame:
        """(group, size, prefix, members) of ``groups`` (node, members).

        Most rows are a group of one. Only the others, and rows that a bitmap takes for such, are shuffled with their prefixes.
        """
        rows = self.signed.filter("size > 0").select(F.col("node").alias("group"), "size", "prefix")
        others = self.signed.filter("size > 0").select("node").join(groups, "node", "left").filter("members is null or members > 1")
        others = self.work.table(others.select(F.col("node").alias("group"), F.coalesce("members", F.lit(0)).alias("members")), "others")
        bits = membership_bits(others, F.col("group"))
        alone = surely_others(rows, F.col("group"), bits).withColumn("members", F.lit(1).cast("long"))
        rest = maybe_members(rows, F.col("group"), bits).join(others, "group", "left")
        return alone.unionByName(rest.withColumn("members", F.coalesce("members", F.lit(1))).filter("members > 0"))

    def passing(self, pairs: DataFrame) -> DataFrame:
        """Pairs (a, b) that may link by sizes and bitmaps."""
        percent = self.percent
        pairs = self.work.table(pairs, "pairs")
        signs = self._signs(pairs.select(F.explode(F.array("a", "b")).alias("node"))).select("node", "size", "bits")
        near = pairs.join(signs.toDF("a", "size_a", "bits_a"), "a").join(signs.toDF("b", "size_b", "bits_b"), "b")

        def close(batches):
            for batch in batches:
                if batch.num_rows:
                    n = batch.num_rows
                    size = np.concatenate([batch.column(f"size_{x}").to_numpy() for x in "ab"])
                    bits = Bitmaps([raw for x in "ab" for raw in batch.column(f"bits_{x}").to_pylist()])
                    keep = _may_link(size, np.zeros(2 * n, np.int64), bits, np.arange(n), np.arange(n, 2 * n), percent)
                    yield batch.select(["a", "b"]).filter(pa.array(keep))

        return self.work.table(near.select("a", "b", "size_a", "size_b", "bits_a", "bits_b").mapInArrow(close, "a long, b long"), "near")

    def verified(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) that link, by the whole sets."""
        work, words, percent = self.work, self.words, self.percent
        wanted = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        wanted = work.table(wanted, "ends")
        wanted = work.table(self._signs(wanted).select("node", FILE, ROW).join(wanted, "node"), "wanted")
        place = F.struct(FILE, ROW)
        texts = maybe_members(self.docs.select(FILE, ROW, "text"), place, membership_bits(wanted, place)).join(wanted, [FILE, ROW]).select("node", "text")

        def as_sets(batches):
            for batch in batches:
                for rows, sets in _sets(batch, words):
                    yield pa.RecordBatch.from_arrays([rows.column("node"), pa.array(sets, pa.list_(pa.int64()))], ["node", "grams"])

        sets = work.table(texts.mapInArrow(as_sets, "node long, grams array<long>"), "sets")

        def compared(batches):
            for batch in batches:
                linked = []
                for left, right in zip(batch.column("left"), batch.column("right"), strict=True):
                    a, b = left.values.to_numpy(), right.values.to_numpy()
                    shared = _shared(a, b)
                    linked.append(100 * shared >= percent * (len(a) + len(b) - shared))
                yield batch.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))

        both = pairs.join(sets.select(F.col("node").alias("a"), F.col("grams").alias("left")), "a")
        both = both.join(sets.select(F.col("node").alias("b"), F.col("grams").alias("right")), "b")
        return work.table(both.select("a", "b", "left", "right").mapInArrow(compared, "a long, b long"), "verified")

    def classes(self) -> DataFrame:
        """(node, class) of the texts with links."""
        work, percent = self.work, self.percent
        # Texts of one size and prefix are a group, named by its first text.
        shared = self.texts.groupBy("group_key").agg(F.min("node").alias("group"), F.count(F.lit(1)).alias("members"))
        shared = work.table(shared.filter("members > 1"), "groups")
        grouped = self.texts.join(shared, "group_key", "left").withColumns({"group": F.coalesce("group", "node"), "members": F.coalesce("members", F.lit(1))})
        members_of = grouped.select("node", "group")

        placed = self._prefixes(grouped.filter("node = group").select("node", "members"))
        placed = placed.select("group", "size", F.posexplode("prefix").alias("place", "gram"), "members")
        often = work.table(placed.groupBy("gram").agg(F.count(F.lit(1)).alias("n"), F.sum("members").alias("rows")).filter("rows > 1"), "often")
        met = maybe_members(placed, F.col("gram"), membership_bits(often, F.col("gram"))).join(often, "gram")
        met = work.table(met.select("group", "size", "place", "gram", "members", "rows", "n"), "met")

        # Groups with the leader of each of their elements, if size and place allow a link.
        weight = met.groupBy("group").agg(F.sum("n").alias("weight"))
        leaders = met.join(weight, "group").groupBy("gram").agg(F.max(F.struct("weight", (-F.col("group")).alias("minus"), "size", "place")).alias("l"))
        met = work.table(met.join(leaders, "gram").withColumn("leader", -F.col("l.minus")), "led")
        pairs = met.filter("group != leader")
        both = F.col("size") + F.col("l.size")
        pairs = pairs.filter(100 * F.least("size", "l.size") >= percent * F.greatest("size", "l.size"))
        pairs = pairs.filter((100 + percent) * F.least(F.col("size") - F.col("place"), F.col("l.size") - F.col("l.place")) >= percent * both)
        pairs = pairs.select("group", "leader").distinct()
        # Every member with the first member of its group and of the leaders' groups.
        star = members_of.join(pairs, "group").select(F.col("node").alias("a"), F.col("leader").alias("b"))
        star = star.unionByName(members_of.filter("node != group").select(F.col("node").alias("a"), F.col("group").alias("b")))
        links = self.verified(self.passing(star))
        classes, failed, grams = components(links, work), None, None
        # All that share an element with its leader have been compared with it; the others are left.
        met = met.filter("rows > 2 and (group != leader or members > 1)").select("group", "size", "place", "gram", "rows", "leader")
        while True:
            tried = self._rest(met, members_of, classes, failed, grams)
            links = links.unionByName(self.verified(self.passing(tried.select("a", "b").distinct())))
            classes = components(links, work)
            # What a large block took for one class is one, unless a pair failed and stayed apart.
            apart = tried.filter("gram is not null")
            for end in "ab":
                of_end = classes.select(F.col("node").alias(end), F.col("class").alias(f"class_{end}"))
                apart = apart.join(of_end, end, "left").withColumn(f"class_{end}", F.coalesce(f"class_{end}", end))
            apart = work.table(apart.filter("class_a != class_b").select("a", "b", "gram"), "apart")
            if apart.isEmpty():
                return classes
            pairs = apart.select("a", "b").distinct()
            failed, grams = pairs if failed is None else failed.unionByName(pairs), apart.select("gram").distinct()

    def _rest(self, met: DataFrame, members_of: DataFrame, classes: DataFrame, failed: DataFrame | None, grams: DataFrame | None) -> DataFrame:
        """Pairs (a, b, gram) that may link, of elements whose members lie in several classes; ``gram`` only for large blocks."""
        work = self.work
        named = members_of.join(classes, "node", "left").withColumn("class", F.coalesce("class", "node"))
        met = met if grams is None else met.join(grams, "gram", "left_semi")
        spans = named.groupBy("group").agg(F.min("class").alias("least"), F.max("class").alias("most"))
        mixed = met.join(spans, "group").groupBy("gram").agg(F.min("least").alias("least"), F.max("most").alias("most"))
        mixed = mixed.filter("least != most").select("gram")
        rest = met.join(mixed, "gram", "left_semi").join(named, "group").filter("node != leader").select("gram", "node", "class", "size", "place", "rows")
        meeting = work.table(rest, "meeting")
        rest = self._dealt(meeting)
        rest = rest.select(
            "gram", F.least("chunk", "other").alias("low"), F.greatest("chunk", "other").alias("high"),
            "node", "class", "size", "place", "chunk", (F.col("rows") > SMALL).alias("large"),
        )
        signs = self._signs(meeting.select("node")).select("node", F.col("bits").alias("whole_bits"), "block_bits")
        rest = rest.join(signs, "node").withColumn("bits", F.when(F.col("large"), F.col("whole_bits")).otherwise(F.col("block_bits")))
        rest = rest.drop("large", "whole_bits", "block_bits")
        if failed is None:
            rest = rest.withColumn("failed", F.lit(None).cast("array<bigint>"))
        else:
            # As many as were tried with a text and failed.
            either = failed.select(F.inline(F.array(F.struct(F.col("a").alias("node"), "b"), F.struct(F.col("b").alias("node"), F.col("a").alias("b")))))
            rest = rest.join(either.groupBy("node").agg(F.collect_set("b").alias("failed")), "node", "left")
        cells = rest.repartition("gram", "low", "high").sortWithinPartitions("gram", "low", "high", "size", "node")
        found = cells.mapInArrow(_cell_pairs(self.percent), "a long, b long, gram long")
        return work.table(found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "gram").distinct(), "rest")

    def _dealt(self, rest: DataFrame) -> DataFrame:
        """The rows with their ``chunk`` and, one row for each, the chunks they are compared with (``other``).

        An element of many members is dealt out by hash, and each row meets all chunks. One of very many is cut into
        bands of size first, where a row meets the chunks of its own band and of the two beside it: no others can link.
        """
        place = F.xxhash64("node")
        chunks = F.ceil(F.col("rows") / BLOCK).cast("int")
        few = rest.filter(F.col("rows") <= BANDED * BLOCK).withColumn("chunk", F.pmod(place, chunks))
        few = few.withColumn("other", F.explode(F.sequence(F.lit(0), chunks - 1).cast("array<long>")))
        # A little wider than need be, so that rounding moves no partner two bands on.
        width = max(1.000001 * math.log(100 / self.percent), 1e-6)
        many = rest.filter(F.col("rows") > BANDED * BLOCK).withColumn("band", F.floor(F.log("size") / width))
        held = many.groupBy("gram", "band").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("n"))
        beside = held.select("gram", "n", F.posexplode(F.array(*(F.col("band") + d for d in (-1, 0, 1)))).alias("at", "band"))
        beside = beside.groupBy("gram", "band").agg(
            *(F.max(F.when(F.col("at") == k, F.col("n"))).alias(name) for k, name in enumerate(("above", "own", "below")))
        ).filter("own is not null")
        many = many.join(beside, ["gram", "band"]).withColumn("chunk", F.col("band") * _BAND + F.pmod(place, "own"))
        others = [
            F.when(F.col(name) > 0, F.transform(F.sequence(F.lit(0).cast("long"), F.col(name) - 1), lambda i, d=d: i + (F.col("band") + d) * _BAND))
            .otherwise(F.array().cast("array<long>"))
            for name, d in (("below", -1), ("own", 0), ("above", 1))
        ]
        many = many.withColumn("other", F.explode(F.concat(*others)))
        return few.unionByName(many.select(few.columns))

    def rows(self) -> DataFrame:
        texts = self.texts.select("digest", "node", "least_id").join(self.classes(), "node", "left").withColumn("class", F.coalesce("class", "node"))
        texts = self.work.table(texts, "classed")
        least = texts.groupBy("class").agg(F.min("least_id").alias("component_id"))
        named = texts.join(least, "class").select("digest", "component_id")
        empty = self.signed.filter("size = 0").select("doc_id", F.col("size").alias("n_shingles"), F.col("doc_id").alias("component_id"))
        found = self.signed.filter("size > 0").select("doc_id", "size", "digest").join(named, "digest")
        return found.select("doc_id", F.col("size").alias("n_shingles"), "component_id").unionByName(empty)


def link(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id.

    Words are what stands between ASCII white space, with A-Z in lower case. A
    text is the set of its distinct runs of ``words`` words; with fewer words all of
    them as one. Two texts link where ``100 * shared >= percent * united``
    elements, so equal texts do. ``component_id`` is the smallest id that links reach; null ids count
    only where there is no other. A text without words (null, empty) is linked with nothing, not even
    with its like: its component is its own id. Rows with equal ids stay rows of their own. An
    empty table gives an empty result; other columns are not read.

    Links are those that make the components; of a group of texts that are all alike
    not every pair is listed. N-grams are compared as hashes of 64 bits.
    """
    work = Scratch(docs.sparkSession)
    rows = located(docs.select(col(id_col).alias("doc_id"), text_of(text_col).alias("text")), work)
    return _Join(rows, work, words, percent).rows()
