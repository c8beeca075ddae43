"""Language-model scores by a hidden Markov model, beside a smoothed unigram model.

The hidden states emit symbols: each of the ``SYMBOLS`` most frequent tokens is
one, the others share a symbol per class of word endings, and a token has its
smoothed share in its class. Baum-Welch counts are made in the tasks over whole
texts and added up by symbol. The forward recursion, scaled at each step, then
gives the exact likelihood of every text.

Token counts grow with the corpus and stay in a table. The most frequent ones,
in a bounded number, are broadcast; a text's other tokens are joined with it.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, ShortType, StringType, StructField, StructType

from cinetally.llm.common import col, crc_mod, smallest_hashes, text_of
from cinetally.sources.scratch import Scratch

FOLDS, HELD_OUT = 5, 1
STATES = 8
#: Training ends with the round that raises the log-likelihood by a smaller share than this.
LEAST_GAIN = 1e-3
SYMBOLS, CLASSES = 4_096, 256
#: Tokens whose counts are broadcast.
FREQUENT = 1 << 18
#: Texts and tokens that are stepped through at once.
SIDE_BY_SIDE, TOKENS_AT_ONCE = 1_024, 1_000_000
#: Octets of text that are encoded at once, and tokens that are counted before they are handed on.
TOGETHER, COUNTED = 1 << 21, 1 << 18
#: Stands for the end of a text; no word is empty.
END = ""
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def tokens_of(text: str) -> list[bytes]:
    """The words in order, without the end. Octets are cut at ASCII white space only."""
    return text.encode("utf-8", "surrogatepass").translate(_LOWER).split()


def _slices(batch: pa.RecordBatch, column: str):
    """The batch in slices of about TOGETHER octets of text."""
    sizes = np.cumsum(pc.binary_length(batch.column(column)).to_numpy())
    begin = 0
    while begin < batch.num_rows:
        end = max(begin + 1, int(np.searchsorted(sizes, (sizes[begin - 1] if begin else 0) + TOGETHER)))
        yield batch.slice(begin, end - begin)
        begin = end


def _class(token: Column) -> Column:
    return (F.crc32(F.right(token, F.lit(2)).cast("binary")) % CLASSES).cast("int")


def class_of(token: str) -> int:
    return zlib.crc32(token[-2:].encode()) % CLASSES


def count_tokens(training: DataFrame, work: Scratch) -> DataFrame:
    """(token, c) of all tokens of rows (text), counted in the tasks before the shuffle."""

    def counted(batches):
        counts: Counter[bytes] = Counter()

        def packed():
            tokens = pa.array(list(counts), pa.binary()).cast(pa.string())
            return pa.RecordBatch.from_arrays([tokens, pa.array(list(counts.values()), pa.int64())], ["token", "c"])

        for batch in batches:
            for part in _slices(batch, "text"):
                for text in part.column("text").to_pylist():
                    counts.update(tokens_of(text))
                counts[END.encode()] += part.num_rows
                if len(counts) > COUNTED:
                    yield packed()
                    counts.clear()
        yield packed()

    parts = training.select("text").mapInArrow(counted, "token string, c long")
    return work.table(parts.groupBy("token").agg(F.sum("c").alias("c")), "counts")


def _frequent(counts: DataFrame) -> DataFrame:
    """The tokens with the largest counts, FREQUENT at most.

    The least count is found on a scale of tenths or so. Sorting with a limit that large
    would bring as many rows of every partition to the driver. Of the step that does not
    fit whole, those with the smallest hashes fill the room that is left.
    """
    step = F.floor(8 * F.log2("c"))
    tallies = counts.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("n")).collect()
    room, chosen = FREQUENT, F.lit(False)
    for tally in sorted(tallies, key=lambda t: -t.step):
        if tally.n > room:
            border = counts.filter(step == tally.step)
            return counts.filter(chosen).unionByName(smallest_hashes(border, "token", room, tally.n).select(*counts.columns))
        room -= tally.n
        chosen = step >= tally.step
    return counts.filter(chosen)


class _Known:
    """What is broadcast about the corpus: the frequent counts, the symbols, the weight of each class."""

    def __init__(self, counts: DataFrame) -> None:
        total = counts.agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).first()
        self.tokens, self.types = total.n or 0, total.v
        rows = sorted(_frequent(counts).collect(), key=lambda r: (-r.c, r.token))
        symbols = {r.token: i for i, r in enumerate(rows[:SYMBOLS])}
        self.first_class = len(symbols)
        # (c + 0.5) summed over the tokens of a class, and one place for all unseen ones.
        by_class = counts.groupBy(_class(F.col("token")).alias("k")).agg(F.sum(F.col("c") + 0.5).alias("w"), F.sum("c").alias("c")).collect()
        weight, seen = np.full(CLASSES, 0.5), np.zeros(CLASSES)
        for r in by_class:
            weight[r.k] += r.w
            seen[r.k] += r.c
        for r in rows[:SYMBOLS]:
            k = class_of(r.token)
            weight[k] -= r.c + 0.5
            seen[k] -= r.c
        self.class_log = np.log10(np.maximum(weight, 0.5)).tolist()
        self.share = np.concatenate([[r.c for r in rows[:SYMBOLS]], seen]) + 0.5
        self.share /= self.share.sum()
        self.denominator = float(np.log10(self.tokens + 0.5 * (self.types + 1)))
        #: By token: symbol, log10(c + 0.5), and what it adds as a member of its class.
        self.frequent = {}
        for r in rows:
            log, symbol, inside = math.log10(r.c + 0.5), symbols.get(r.token), 0.0
            if symbol is None:
                k = class_of(r.token)
                symbol, inside = self.first_class + k, log - self.class_log[k]
            self.frequent[r.token.encode()] = (symbol, log, inside)


class Encoder:
    """Texts as symbols, many at once: a number for each frequent token, and for the rarer ones of the texts in hand."""

    def __init__(self, corpus: SimpleNamespace) -> None:
        self.class_log, self.first_class = np.array(corpus.class_log), corpus.first_class
        entries = corpus.frequent.values()
        self.symbol, self.log, self.inside = (np.array([e[k] for e in entries], t) for k, t in enumerate((np.int64, float, float)))
        self.number = _Numbers(corpus.frequent)

    def encode(self, texts: list[str]) -> list[pa.Array]:
        """By text: symbols, counted tokens known here, sum of log10(c + 0.5) of those, what classes add, rarer tokens and how often."""
        number, end, frequent = self.number, [END.encode()], len(self.log)
        ids, lengths = [], []
        for text in texts:
            tokens = tokens_of(text)
            lengths.append(len(tokens) + 1)
            ids += map(number.__getitem__, tokens + end)
        ids, lengths = np.array(ids, np.int64), np.array(lengths)
        rare = number.forget()
        plain = [token.decode("utf-8", "surrogatepass") for token in rare]
        kinds = np.array([class_of(token) for token in plain], np.int64)
        starts = np.cumsum(lengths) - lengths
        symbol = np.concatenate([self.symbol, self.first_class + kinds])[ids]
        log = np.concatenate([self.log, np.zeros(len(rare))])[ids]
        inside = np.concatenate([self.inside, -self.class_log[kinds]])[ids]
        # Distinct rare tokens of each text.
        at = np.flatnonzero(ids >= frequent)
        text = np.searchsorted(starts, at, "right") - 1
        pairs, times = np.unique(text * max(1, len(rare)) + (ids[at] - frequent), return_counts=True)
        borders = np.searchsorted(pairs, np.arange(len(texts) + 1) * max(1, len(rare)))
        which = pairs % max(1, len(rare))
        return [
            _list_array(np.append(starts, len(ids)), pa.array(symbol.astype(np.int16))),
            pa.array(np.add.reduceat((ids < frequent).astype(np.int64), starts)),
            pa.array(np.add.reduceat(log, starts)),
            pa.array(np.add.reduceat(inside, starts)),
            _list_array(borders, pa.array(plain, pa.string()).take(pa.array(which))),
            _list_array(borders, pa.array(times.astype(np.int32))),
        ]


class _Numbers(dict):
    """The frequent tokens by number; others get the next ones, until they are forgotten."""

    def __init__(self, frequent: dict) -> None:
        super().__init__((token, i) for i, token in enumerate(frequent))
        self.rare: list[bytes] = []

    def __missing__(self, token: bytes) -> int:
        self.rare.append(token)
        self[token] = number = len(self)
        return number

    def forget(self) -> list[bytes]:
        rare, self.rare = self.rare, []
        for token in rare:
            del self[token]
        return rare


def _list_array(offsets: np.ndarray, values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), values)


class Model:
    """Start, transition and emission probabilities."""

    def __init__(self, share: np.ndarray) -> None:
        random = np.random.default_rng(0)
        self.start = np.full(STATES, 1 / STATES)
        self.move = np.full((STATES, STATES), 0.1 / (STATES - 1))
        np.fill_diagonal(self.move, 0.9)
        emit = share * (0.25 + random.random((STATES, len(share))) ** 2)
        self.emit = emit / emit.sum(axis=1, keepdims=True)

    def fitted(self, counts: np.ndarray, share: np.ndarray) -> None:
        """Take over the expected counts: a row per symbol, then a row per state left, then the starts."""
        size = len(share)
        emit = counts[:size].T + 20 * share
        self.emit = emit / emit.sum(axis=1, keepdims=True)
        move = counts[size : size + STATES] + 0.1
        self.move = move / move.sum(axis=1, keepdims=True)
        start = counts[size + STATES] + 0.1
        self.start = start / start.sum()


def _groups(lengths: np.ndarray):
    """Indices of texts of like length, longest first, as many as are stepped through at once."""
    order = np.argsort(-lengths, kind="stable")
    ends = np.cumsum(lengths[order])
    at = 0
    while at < len(order):
        fits = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + TOKENS_AT_ONCE, "right"))
        until = min(at + SIDE_BY_SIDE, max(at + 1, fits))
        yield order[at:until]
        at = until


class _Steps:
    """Texts side by side, one step a position; they are sorted by length, so those that have ended drop out at the end.

    Arrays have a row for each position, those of one step behind those of the step before, and a column for each state.
    """

    def __init__(self, group, lengths, offsets, values, emit: np.ndarray) -> None:
        longest = lengths[group]
        self.active = np.searchsorted(-longest, -np.arange(1, longest[0] + 1), "right").tolist()
        starts = offsets[group]
        self.symbols = values[np.concatenate([starts[:n] + t for t, n in enumerate(self.active)])]
        self.emitted = emit[self.symbols]
        ends = np.cumsum(self.active).tolist()
        self.spans = [slice(end - n, end) for end, n in zip(ends, self.active, strict=True)]

    def forward(self, states: np.ndarray, start: np.ndarray, move: np.ndarray) -> np.ndarray:
        """Turns what is emitted into the scaled forward variables; gives the scales."""
        scales, ones, before = np.empty((len(states), 1), states.dtype), np.ones((STATES, 1), states.dtype), None
        for n, span in zip(self.active, self.spans, strict=True):
            state = states[span]
            state *= start if before is None else before[:n] @ move
            state /= np.matmul(state, ones, out=scales[span])
            before = state
        return scales


def forward(model: SimpleNamespace | Model, lengths: np.ndarray, values: np.ndarray) -> np.ndarray:
    """log10 of the likelihood of each sequence."""
    result = np.zeros(len(lengths))
    offsets = np.cumsum(lengths) - lengths
    emit = np.ascontiguousarray(model.emit.T)
    for group in _groups(lengths):
        steps = _Steps(group, lengths, offsets, values, emit)
        logs = np.log10(steps.forward(steps.emitted, model.start, model.move)[:, 0])
        total = np.zeros(len(group))
        for n, span in zip(steps.active, steps.spans, strict=True):
            total[:n] += logs[span]
        result[group] = total
    return result


def expected_counts(model: SimpleNamespace | Model, lengths: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Baum-Welch counts of sequences, laid out as ``Model.fitted`` takes them."""
    return counts_and_likelihood(model, lengths, values)[0]


def counts_and_likelihood(model: SimpleNamespace | Model, lengths: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, float]:
    """The expected counts, and log10 of the likelihood of all sequences.

    The variables of a position are scaled, so single precision holds them; sums over positions are doubles.
    """
    likelihood = 0.0
    size = model.emit.shape[1]
    counts = np.zeros((size + STATES + 1, STATES))
    offsets = np.cumsum(lengths) - lengths
    emit, move, start = (np.ascontiguousarray(x, np.float32) for x in (model.emit.T, model.move, model.start))
    turned = np.ascontiguousarray(move.T)
    for group in _groups(lengths):
        steps = _Steps(group, lengths, offsets, values, emit)
        states, after = steps.emitted.copy(), steps.emitted
        scales = steps.forward(states, start, move)
        likelihood += float(np.log10(scales, dtype=np.float64).sum())
        # What follows a position, with what the position itself emits.
        after /= scales
        # The forward variables become posteriors, from the end; a move is counted while both are at hand.
        moves, ahead = np.zeros((STATES, STATES)), None
        for span in reversed(steps.spans):
            if ahead is not None:
                at = slice(span.start, span.start + len(ahead))
                state, back = states[at], ahead @ turned
                moves += state.T @ ahead
                state *= back
                after[at] *= back
            ahead = after[span]
        counts[size : size + STATES] += moves * model.move
        counts[-1] += states[steps.spans[0]].sum(axis=0, dtype=np.float64)
        for k in range(STATES):
            counts[:size, k] += np.bincount(steps.symbols, states[:, k], size)
    return counts, likelihood


def _lists(column) -> tuple[np.ndarray, np.ndarray]:
    return np.diff(column.offsets.to_numpy()).astype(np.int64), column.flatten().to_numpy().astype(np.int64)


def train(sequences: DataFrame, share: np.ndarray) -> Model:
    """A model fitted to all rows (symbols), by Baum-Welch with the counts added up over the tasks, until it hardly gains."""
    model = Model(share)
    names = [f"s{k}" for k in range(STATES)]
    schema = ", ".join(["place int", *(f"{n} double" for n in names)])
    before = -math.inf
    while True:
        shared = sequences.sparkSession.sparkContext.broadcast(SimpleNamespace(**vars(model)))

        def counted(batches, shared=shared):
            counts, likelihood = 0, 0.0
            for batch in batches:
                if batch.num_rows:
                    more, log = counts_and_likelihood(shared.value, *_lists(batch.column(0)))
                    counts, likelihood = counts + more, likelihood + log
            if not isinstance(counts, int):
                # The last row is the likelihood.
                counts = np.vstack([counts, np.full(STATES, likelihood)])
                place = np.flatnonzero(counts.any(axis=1))
                columns = [pa.array(place, pa.int32()), *(pa.array(counts[place, k]) for k in range(STATES))]
                yield pa.RecordBatch.from_arrays(columns, ["place", *names])

        total = np.zeros((len(share) + STATES + 2, STATES))
        summed = sequences.mapInArrow(counted, schema).groupBy("place").agg(*[F.sum(n).alias(n) for n in names])
        for place, *row in summed.collect():
            total[place] = row
        shared.unpersist()
        total, likelihood = total[:-1], total[-1, 0]
        if not total.any():
            return model
        model.fitted(total, share)
        if likelihood - before <= LEAST_GAIN * abs(likelihood):
            return model
        before = likelihood


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Both models learn from the texts outside the fold ``crc32(id) mod 5 = 1``.
    ``base_score`` is the text's log10 probability under the smoothed unigram
    model, ``score`` that under the hidden Markov model. Null counts as
    empty, which has the end as its only token. Repeated rows count as often as
    they occur, rows with a null id are scored and learned from. Without
    training texts all counts are 0. An empty table gives an empty result;
    other columns are not read.
    """
    spark = docs.sparkSession
    work = Scratch(spark)
    texts = docs.select(col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    texts = texts.withColumn("held_out", crc_mod("doc_id", FOLDS) == HELD_OUT)
    counts = count_tokens(texts.filter("not held_out"), work)
    known = _Known(counts)
    shared = spark.sparkContext.broadcast(SimpleNamespace(**vars(known)))

    def encoded(batches):
        encoder = Encoder(shared.value)
        for batch in batches:
            for part in _slices(batch, "text"):
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("held_out"), *encoder.encode(part.column("text").to_pylist())], names
                )

    fields = [
        StructField("symbols", ArrayType(ShortType())), StructField("known", LongType()), StructField("totals", DoubleType()),
        StructField("inside", DoubleType()), StructField("rare", ArrayType(StringType())), StructField("times", ArrayType(IntegerType())),
    ]
    schema = StructType([texts.schema["doc_id"], texts.schema["held_out"], *fields])
    names = schema.names
    rows = texts.select("doc_id", "held_out", "text").mapInArrow(encoded, schema)
    # Written, so that the numbers stay.
    rows = work.table(rows.withColumn("row", F.monotonically_increasing_id()), "encoded")
    fitted = train(rows.filter("not held_out").select("symbols"), known.share)
    model = spark.sparkContext.broadcast(SimpleNamespace(**vars(fitted)))

    pairs = rows.select("row", F.explode(F.arrays_zip("rare", "times")).alias("t")).select("row", F.col("t.rare").alias("token"), "t.times")
    log = F.log10(F.coalesce("c", F.lit(0)) + 0.5)
    rare = pairs.join(counts, "token", "left").groupBy("row").agg(
        F.sum(F.col("times") * log).alias("rare_log"), F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("rare_known")
    )

    def likelihoods(batches):
        for batch in batches:
            if batch.num_rows:
                value = forward(model.value, *_lists(batch.column("symbols")))
                yield pa.RecordBatch.from_arrays(
                    [*map(batch.column, kept), pa.array(np.diff(batch.column("symbols").offsets.to_numpy()), pa.int64()), pa.array(value)],
                    [*kept, "n_tokens", "likelihood"],
                )

    kept = ["row", "doc_id", "held_out", "known", "totals", "inside"]
    slim = rows.select(*kept, "symbols")
    out = StructType([*(slim.schema[n] for n in kept), StructField("n_tokens", LongType()), StructField("likelihood", DoubleType())])
    scored = slim.mapInArrow(likelihoods, out).join(rare, "row", "left")
    rare_log = F.coalesce("rare_log", F.lit(0.0))
    return scored.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(known.tokens).cast("bigint").alias("train_tokens"),
        (F.col("totals") + rare_log - F.col("n_tokens") * F.lit(known.denominator)).alias("base_score"),
        (F.col("likelihood") + F.col("inside") + rare_log).alias("score"),
    )
