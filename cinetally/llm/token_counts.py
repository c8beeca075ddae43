"""Token counts by two lookups on the map side.

Pre-tokens are the stretches between ASCII white space: the tokenizer drops
white space and never joins across it, so the counts of a text's pre-tokens add
up to its own. The lengths of the most frequent ones are broadcast in one
table of bounded size; the others are encoded by the library, through a
bounded cache in each Python worker. No pre-token is shuffled for counting.
"""

from __future__ import annotations

import os
from collections import Counter

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cinetally.llm.common import col, text_of, worker_cache

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
TOKEN_LIMIT = 2048
#: Entries of the broadcast table, and what each task proposes for it.
FREQUENT, PROPOSED = 50_000, 4_000
#: Longer pre-tokens are encoded each time; tables would grow with them.
KEY_CHARS = 64
CACHED = 400_000


def _pre_tokens(text: str) -> list[str]:
    for space in "\t\n\v\f\r":
        text = text.replace(space, " ")
    return text.split(" ")


def _heavy(batches):
    """The most frequent pre-tokens of a task. Rare ones are let go whenever the counter is full."""
    seen: Counter[str] = Counter()
    for batch in batches:
        for text in batch.column(0).to_pylist():
            seen.update(_pre_tokens(text))
        if len(seen) > 20 * PROPOSED:
            seen = Counter(dict(seen.most_common(10 * PROPOSED)))
    top = [(w, n) for w, n in seen.most_common(PROPOSED) if 0 < len(w) <= KEY_CHARS]
    yield pa.RecordBatch.from_arrays(
        [pa.array([w for w, _ in top], pa.string()), pa.array([n for _, n in top], pa.int64())], ["piece", "n"]
    )


class _Lengths:
    """Lengths of pre-tokens in a worker: the broadcast table, then the cache, then the library."""

    def __init__(self, vocabulary: bytes, frequent: dict[str, int]) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        shared = worker_cache("token_counts")
        key = hash(vocabulary)
        if key not in shared:
            shared[key] = (Tokenizer.from_str(vocabulary.decode()), {"": 0})
        self.tokenizer, self.cache = shared[key]
        self.frequent = frequent

    def encode(self, pieces: list[str]) -> list[int]:
        return [len(e.ids) for e in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]

    def totals(self, texts: list[str]) -> list[int]:
        first, cached = self.frequent.get, self.cache.get
        totals, missing = [], []
        for text in texts:
            total, rest = 0, []
            for piece, n in zip(pieces := _pre_tokens(text), map(first, pieces), strict=True):
                if n is None:
                    rest.append(piece)
                else:
                    total += n
            totals.append(total)
            missing.append(rest)
        new = list({p for rest in missing for p in rest if cached(p) is None})
        if len(self.cache) + len(new) > CACHED:
            self.cache.clear()
            self.cache[""] = 0
            new = list({p for rest in missing for p in rest if p})
        found = dict(zip(new, self.encode(new), strict=True))
        self.cache.update((p, n) for p, n in found.items() if len(p) <= KEY_CHARS)
        return [t + sum(found[p] if p in found else cached(p) for p in rest) for t, rest in zip(totals, missing, strict=True)]


def _texts_in_parts(batch, size: int = 512):
    for start in range(0, batch.num_rows, size):
        yield batch.slice(start, size)


def token_counts(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    *,
    vocabulary: str = VOCABULARY,
    limit: int = TOKEN_LIMIT,
    frequent: int = FREQUENT,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_tokens, over_limit.

    Counts are those of the library for the whole text without added special
    tokens; strings of special tokens inside a text count as the library takes
    them. Null counts as empty, which has 0 tokens. Repeated rows and null ids
    are returned as they come; an empty table gives an empty result. Other
    columns are not read.

    The vocabulary file is read on the driver and broadcast, as is the table
    of at most ``frequent`` lengths; the table affects speed only.
    """
    spark = docs.sparkSession
    with open(vocabulary, "rb") as file:
        content = spark.sparkContext.broadcast(file.read())
    texts = docs.select(col(id_col).alias("doc_id"), text_of(text_col).alias("text"))

    def lengths(batches):
        known = _Lengths(content.value, {})
        for batch in batches:
            pieces = batch.column(0).to_pylist()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(known.encode(pieces), pa.int64())], ["piece", "n"])

    heavy = texts.select("text").mapInArrow(_heavy, "piece string, n bigint").groupBy("piece").agg(F.sum("n").alias("n"))
    heavy = heavy.orderBy(F.desc("n"), "piece").limit(frequent).select("piece")
    rows = heavy.mapInArrow(lengths, "piece string, n bigint").collect()
    common = spark.sparkContext.broadcast({r.piece: r.n for r in rows})

    def counts(batches):
        known = _Lengths(content.value, common.value)
        for batch in batches:
            for part in _texts_in_parts(batch):
                n = pa.array(known.totals(part.column(2).to_pylist()), pa.int64())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), n], ["doc_id", "n_bytes", "n_tokens"])

    kind = texts.schema["doc_id"].dataType.simpleString()
    sized = texts.select("doc_id", F.octet_length("text").cast("bigint").alias("n_bytes"), "text")
    counted = sized.mapInArrow(counts, f"doc_id {kind}, n_bytes bigint, n_tokens bigint")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
