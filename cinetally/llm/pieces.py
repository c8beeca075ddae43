"""SentencePiece encoding and decoding by suffix-array matching.

The words of a batch that are not known yet are joined to one text, whose
suffixes are sorted by their first characters. Every piece of the vocabulary is
looked up in it by binary search; the ranges found are the edges (start, end,
piece) of a graph over the positions. Edges are sorted by position and relaxed
from left to right.

The models in hand merge pairs (BPE), so what a position remembers is not a
distance but the last piece of the one encoding of the text up to there. An
edge is taken when merging its piece and the remembered one together would
leave both as they are: then the encoding of the longer text is that of the
shorter one and the edge's piece. No piece has white space inside or behind other characters,
which is why words can be encoded one by one and remembered.
"""

from __future__ import annotations

import re

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, LongType, StringType, StructField, StructType

from cinetally.llm.common import col, text_of, worker_cache

MODEL = public_tokenizers.path("piece_bpe_32k.model")
SPACE = "▁"
#: Positions that are indexed at once, and words and pairs a worker remembers, the older half of which makes room.
INDEXED, CACHED_WORDS, CACHED_PAIRS, KEY_CHARS = 1 << 18, 400_000, 500_000, 64
#: Octets of text whose new words are indexed together.
TOGETHER = 1 << 22
#: Longer words are relaxed edge by edge.
SIDE_BY_SIDE = 64
_UNREACHED, _START, _NEVER = -2, -1, float("inf")
#: White space with what follows up to the next white space; line ends are no part of any piece.
_WORDS = re.compile(f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n+")
#: The same, cut between letters and marks, for models without pieces that hold both side by side.
_LETTER, _MARK = "A-Za-zÀ-ÖØ-öø-ÿ", "!-/:-@\\[-`{-~"
_BESIDE = re.compile(f"[{_LETTER}][{_MARK}]|[{_MARK}][{_LETTER}]")
_PARTS = re.compile(
    f"{SPACE}*(?:[{_LETTER}]+(?=[{_MARK}{SPACE}\n]|$)|[{_MARK}]+(?=[{_LETTER}{SPACE}\n]|$)|[^{SPACE}\n]+)|{SPACE}+|\n+"
)


class Vocabulary:
    """The pieces of a model file."""

    def __init__(self, model: bytes) -> None:
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(model)
        spec, norm = proto.trainer_spec, proto.normalizer_spec
        kinds = type(proto.pieces[0]) if proto.pieces else None
        usable = (
            spec.model_type == spec.BPE and spec.byte_fallback and not spec.treat_whitespace_as_suffix
            and not norm.precompiled_charsmap and norm.add_dummy_prefix and norm.escape_whitespaces
            and not norm.remove_extra_whitespaces
        )
        if not usable:
            raise ValueError("only BPE models with byte fallback and identity normalisation are read")
        self.id = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == kinds.NORMAL}
        self.cost = {p.piece: -p.score for p in proto.pieces if p.type == kinds.NORMAL}
        self.unknown = next(i for i, p in enumerate(proto.pieces) if p.type == kinds.UNKNOWN)
        self.octet = {int(p.piece[3:5], 16): i for i, p in enumerate(proto.pieces) if p.type == kinds.BYTE}
        if any(SPACE in p.lstrip(SPACE) or p != SPACE * len(p) and p.startswith(SPACE * 2) for p in self.id):
            raise ValueError("pieces with white space inside are not read")
        self.segments = (_WORDS if any(_BESIDE.search(p) for p in self.id) else _PARTS).findall
        self.runs = {len(p) for p in self.id if not p.strip(SPACE)}
        self.octets = [b""] * len(proto.pieces)
        for piece, i in self.id.items():
            self.octets[i] = piece.replace(SPACE, " ").encode()
        for value, i in self.octet.items():
            self.octets[i] = bytes([value])
        words = sorted(p for p in self.id if p.strip(SPACE) or p == SPACE)
        self.width = max(map(len, words))
        self.text = {i: p for p, i in self.id.items()}
        self.lowest = np.array(words, f"U{self.width}")
        self.highest = np.array([p + chr(0x10FFFF) * (self.width - len(p)) for p in words], f"U{self.width}")
        self.ids = np.array([self.id[p] for p in words], np.int32)
        self.lengths = np.array([len(p) for p in words], np.int32)

    def merged(self, text: str) -> list[str]:
        """Merge the cheapest neighbours, the leftmost of equals first, until none is left."""
        parts, cost = list(text), self.cost.get
        costs = [cost(a + b, _NEVER) for a, b in zip(parts, parts[1:])]
        while costs and (least := min(costs)) < _NEVER:
            i = costs.index(least)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del costs[i]
            if i:
                costs[i - 1] = cost(parts[i - 1] + parts[i], _NEVER)
            if i < len(costs):
                costs[i] = cost(parts[i] + parts[i + 1], _NEVER)
        return parts


class Ageing:
    """A dictionary of bounded size in two halves. What is found in the older half moves to the younger one; when that is full the older half goes."""

    def __init__(self, most: int) -> None:
        self.half, self.young, self.old = most // 2, {}, {}

    def __len__(self) -> int:
        return len(self.young) + len(self.old)

    def get(self, key):
        value = self.young.get(key)
        if value is None and (value := self.old.get(key)) is not None:
            self.put(key, value)
        return value

    def get_all(self, keys: list) -> list:
        """The values, None where there is none."""
        found = list(map(self.young.get, keys))
        for i, value in enumerate(found):
            if value is None and self.old:
                found[i] = self.get(keys[i])
        return found

    def put(self, key, value) -> None:
        if len(self.young) >= self.half:
            self.young, self.old = {}, self.young
        self.young[key] = value


class _Numbers(dict):
    """Numbers for keys, in the order in which they are first asked for."""

    def __missing__(self, key) -> int:
        number = self[key] = len(self)
        return number


class Encoder:
    """Encodes and decodes in a worker, with what the worker has seen before."""

    def __init__(self, model: bytes) -> None:
        shared = worker_cache("pieces")
        key = hash(model)
        if key not in shared:
            shared[key] = (Vocabulary(model), Ageing(CACHED_WORDS), Ageing(CACHED_PAIRS))
        self.vocabulary, self.words, self.pairs = shared[key]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        cut, numbers = self.vocabulary.segments, _Numbers()
        parts = [np.array([numbers[s] for s in cut(SPACE + t.replace(" ", SPACE))] if t else [], np.int64) for t in texts]
        segments = list(numbers)
        found = self.words.get_all(segments)
        new = [i for i, ids in enumerate(found) if ids is None]
        for i, ids in zip(new, self._segments([segments[i] for i in new]), strict=True):
            found[i] = ids
            if len(segments[i]) <= KEY_CHARS:
                self.words.put(segments[i], ids)
        # Every segment's ids one after the other; a text takes the stretches of its segments.
        ids, sizes = np.frombuffer(b"".join(found), np.int32), np.array([len(f) // 4 for f in found], np.int64)
        begins = np.cumsum(sizes) - sizes
        encoded = []
        for own in parts:
            size = sizes[own]
            encoded.append(ids[np.repeat(begins[own] - np.cumsum(size) + size, size) + np.arange(size.sum())])
        return encoded

    def decode(self, ids: np.ndarray) -> str:
        octets = self.vocabulary.octets
        text = b"".join([octets[i] for i in ids.tolist()]).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text

    def _segments(self, segments: list[str]) -> list[bytes]:
        # Of the white space before a word only the last character can join it; the rest merges last, on its own.
        words = []
        for s in segments:
            run = len(s) - len(s.lstrip(SPACE))
            words.append((run - 1, s[run - 1 :]) if run and run < len(s) else (run, s[run:]))
        distinct = list(dict.fromkeys(w for _, w in words if w))
        ids = dict(zip(distinct, self._encode_words(distinct), strict=True))
        space = self.vocabulary.id[SPACE]
        result = []
        for run, word in words:
            own = ids.get(word, [])
            if run and own and own[0] == space:
                run, own = run + 1, own[1:]
            result.append(np.array(self._run(run) + own, np.int32).tobytes())
        return result

    def _run(self, length: int) -> list[int]:
        """White space alone: all its merges cost the same, so it grows from the left."""
        parts: list[int] = []
        for _ in range(length):
            parts.append(1)
            while len(parts) > 1 and parts[-2] + parts[-1] in self.vocabulary.runs:
                parts[-2:] = [parts[-2] + parts[-1]]
        return [self.vocabulary.id[SPACE * n] for n in parts]

    def _edges(self, codes: np.ndarray, begin: int, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Edges (start, end, piece) with their start in [begin, end), by start and length.

        A suffix is sorted by as many characters as the longest piece has.
        """
        v = self.vocabulary
        windows = np.lib.stride_tricks.sliding_window_view(codes[begin : end + v.width], v.width)[: end - begin]
        suffixes = np.ascontiguousarray(windows).view(f"U{v.width}").ravel()
        order = np.argsort(suffixes, kind="stable")
        ordered = suffixes[order]
        low = np.searchsorted(ordered, v.lowest, "left")
        count = np.searchsorted(ordered, v.highest, "right") - low
        piece = np.repeat(np.arange(len(count)), count)
        within = np.arange(len(piece)) - np.repeat(np.cumsum(count) - count, count)
        start = order[low[piece] + within]
        length, ids = v.lengths[piece], v.ids[piece]
        # Characters that are no piece: an edge of their own.
        alone = np.ones(end - begin, bool)
        alone[start[length == 1]] = False
        alone[codes[begin:end] == _SEPARATOR] = False
        extra = np.flatnonzero(alone)
        start = np.concatenate([start, extra])
        length = np.concatenate([length, np.ones(len(extra), np.int32)])
        ids = np.concatenate([ids, np.full(len(extra), v.unknown, np.int32)])
        by_position = np.argsort(start * (v.width + 1) + length, kind="stable")
        start, length, ids = start[by_position] + begin, length[by_position], ids[by_position]
        return start, start + length, ids.astype(np.int64)

    def _encode_words(self, words: list[str]) -> list[list[int]]:
        v = self.vocabulary
        joined = np.frombuffer("".join(w + "\n" for w in words).encode("utf-32-le"), np.uint32)
        # Line ends separate the words, which have none, except those made of nothing else.
        codes = np.concatenate([joined, np.zeros(v.width, np.uint32)])
        sizes = np.array([len(w) + 1 for w in words], np.int64)
        starts = np.cumsum(sizes) - sizes
        last = np.full(len(joined) + 1, _UNREACHED, np.int64)
        last[starts] = _START
        for begin in range(0, len(joined), INDEXED):
            self._relax(*self._edges(codes, begin, min(begin + INDEXED, len(joined))), starts, last)
        last = last.tolist()
        return [self._path(w, s, last) for w, s in zip(words, starts.tolist(), strict=True)]

    def _relax(self, start: np.ndarray, end: np.ndarray, piece: np.ndarray, starts: np.ndarray, last: np.ndarray) -> None:
        """Take the edges by their place in the word, all words side by side: an edge only asks what came before it in its word."""
        place = start - starts[np.searchsorted(starts, start, "right") - 1]
        by_place = np.argsort(place, kind="stable")
        start, end, piece, place = start[by_place], end[by_place], piece[by_place], place[by_place]
        borders = np.searchsorted(place, np.arange(SIDE_BY_SIDE + 1))
        for low, high in zip(borders[:-1].tolist(), borders[1:].tolist(), strict=True):
            if low < high:
                self._step(start[low:high], end[low:high], piece[low:high], last)
        for i in range(int(borders[-1]), len(place)):
            self._step(start[i : i + 1], end[i : i + 1], piece[i : i + 1], last)

    def _step(self, start: np.ndarray, end: np.ndarray, piece: np.ndarray, last: np.ndarray) -> None:
        """Edges no two of which begin in the same word at different places; those from one place end at different ones."""
        unknown = self.vocabulary.unknown
        before = last[start]
        at = np.flatnonzero((before != _UNREACHED) & (last[end] == _UNREACHED))
        alone = at[piece[at] == unknown]
        last[end[alone]] = unknown
        at = at[piece[at] != unknown]
        if not len(at):
            return
        known = np.where((before[at] > 0) & (before[at] != unknown), before[at], -1)
        keys, which = np.unique((known << 20) | piece[at], return_inverse=True)
        fits = self.pairs.get_all(keys := keys.tolist())
        for i, known in enumerate(fits):
            if known is None:
                fits[i] = self._fits(keys[i] >> 20, keys[i] & 0xFFFFF)
                self.pairs.put(keys[i], fits[i])
        good = at[np.array(fits)[which]]
        last[end[good]] = piece[good]

    def _fits(self, before: int, piece: int) -> bool:
        v = self.vocabulary
        if before < 0:
            return v.merged(v.text[piece]) == [v.text[piece]]
        return v.merged(v.text[before] + v.text[piece]) == [v.text[before], v.text[piece]]

    def _path(self, word: str, start: int, last: list[int]) -> list[int]:
        """The pieces of a word, from its end; characters without a piece become their octets."""
        v, ids, at = self.vocabulary, [], len(word)
        if not word.strip("\n"):
            return [v.octet[10]] * len(word)
        while at:
            piece = last[start + at]
            if piece == v.unknown:
                at -= 1
                ids += [v.octet[b] for b in reversed(word[at].encode())]
            else:
                at -= len(v.text[piece])
                ids.append(piece)
        return ids[::-1]


_SEPARATOR = 10


def _mapped(docs: DataFrame, text_col: str, model: str, build, fields: list[StructField], names: list[str]) -> DataFrame:
    spark = docs.sparkSession
    with open(model, "rb") as file:
        content = spark.sparkContext.broadcast(file.read())

    def work(batches):
        encoder = Encoder(content.value)
        for batch in batches:
            text = batch.column("_llm_text")
            sizes = np.cumsum(pc.binary_length(text).to_numpy())
            start = 0
            while start < batch.num_rows:
                end = max(start + 1, int(np.searchsorted(sizes, (sizes[start - 1] if start else 0) + TOGETHER)))
                part, start = batch.slice(start, end - start), end
                kept = [part.column(n) for n in names]
                yield pa.RecordBatch.from_arrays([*kept, *build(encoder, part.column("_llm_text").to_pylist())], [*names, *(f.name for f in fields)])

    rows = docs.select(*[col(n) for n in names], text_of(text_col).alias("_llm_text"))
    return rows.mapInArrow(work, StructType([*(rows.schema[n] for n in names), *fields]))


def _lists(encoded: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(e) for e in encoded])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(encoded) if encoded else np.empty(0, np.int32)))


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, model: str = MODEL) -> DataFrame:
    """One row per row of ``docs``: doc_id, pieces, n_pieces, text, round_trip.

    ``pieces`` are the ids that the library gives for the whole text, ``text``
    is decoded from them, ``round_trip`` tells whether it is the text as it
    was (a text with the model's own sign for a space comes back with a space).
    Null counts as empty, which has no pieces. Repeated rows and null ids are
    returned as they come; an empty table gives an empty result; other columns
    are not read. The model file is read on the driver and broadcast.
    """

    def build(encoder: Encoder, texts: list[str]):
        encoded = encoder.encode(texts)
        decoded = [encoder.decode(e) for e in encoded]
        counts = pa.array([len(e) for e in encoded], pa.int64())
        same = pa.array([a == b for a, b in zip(texts, decoded, strict=True)], pa.bool_())
        return _lists(encoded), counts, pa.array(decoded, pa.string()), same

    fields = [
        StructField("pieces", ArrayType(IntegerType())), StructField("n_pieces", LongType()),
        StructField("decoded", StringType()), StructField("round_trip", BooleanType()),
    ]
    rows = docs.select(col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    return _mapped(rows, "text", model, build, fields, ["doc_id"]).withColumnRenamed("decoded", "text")


def decode(rows: DataFrame, id_col: str = "doc_id", pieces_col: str = "pieces", *, model: str = MODEL) -> DataFrame:
    """One row per row: doc_id and the text of its pieces; null and no pieces give the empty text."""
    spark = rows.sparkSession
    with open(model, "rb") as file:
        content = spark.sparkContext.broadcast(file.read())

    def work(batches):
        encoder = Encoder(content.value)
        for batch in batches:
            texts = [encoder.decode(np.array(p or [], np.int32)) for p in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    picked = rows.select(col(id_col).alias("doc_id"), col(pieces_col).cast("array<int>").alias("pieces"))
    return picked.mapInArrow(work, StructType([picked.schema["doc_id"], StructField("text", StringType())]))
