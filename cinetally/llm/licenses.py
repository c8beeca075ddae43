"""License scans by an exact set-similarity join of text blocks with templates.

A block is a line of a text; longer lines are cut into overlapping blocks. The
words of the whole text are cut likewise, with line ends as mere
separators, which finds notices that are wrapped over several lines. Blocks are long
enough to hold any template whole, wherever it begins. The tokens are ordered by how many documents of the whole table have them. A block
that shares ``need`` tokens with a template also shares one of the template's
``size - need + 1`` rarest tokens, which finds the candidates; length and
position filters drop most of the rest before the sets are compared.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

from cinetally.llm.common import col, text_of

THRESHOLD = 0.8
#: Words of a block, or more for templates that need more, and from one block to the next.
BLOCK_WORDS, BLOCK_STEP = 32, 8
#: Phrases whose places are counted, with their labels.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
#: Common notices of public licenses, with their labels.
TEMPLATES = (
    ("released under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "mit"),
    ("licensed under the apache license version 2 0", "apache"),
    ("this work is licensed under the gnu general public license version 3", "gpl"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", "gpl"),
    ("redistribution and use in source and binary forms with or without modification are permitted", "bsd"),
    ("this source code form is subject to the terms of the mozilla public license v 2 0", "mpl"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("licensed under a creative commons attribution 4 0 international license", "cc-by"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
    ("all rights reserved", "all-rights-reserved"),
)

#: Octets as words see them: A-Z lower-cased, other ASCII but letters and digits as space. UTF-8 puts all else above.
_OCTETS = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def _split(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_OCTETS).split()


def _blocks(words: list[bytes], size: int):
    start = 0
    while words:
        yield words[start : start + size]
        if start + size >= len(words):
            return
        start += BLOCK_STEP


def _blocks_with(words: list[bytes], size: int, rare: frozenset[bytes]):
    """(number, block) of those of ``_blocks`` that have a word of ``rare``."""
    last, following = max(0, -(-(len(words) - size) // BLOCK_STEP)), 0
    for at, word in enumerate(words):
        if word in rare:
            first = max(following, -(-(at - size + 1) // BLOCK_STEP))
            following = max(following, min(at // BLOCK_STEP, last) + 1)
            for number in range(first, following):
                yield number, words[number * BLOCK_STEP : number * BLOCK_STEP + size]


class _Templates:
    """The templates in the global order of tokens, indexed by their rarest ones."""

    def __init__(self, templates, frequency: dict[bytes, int], threshold: float) -> None:
        tokens = {w for text, _ in templates for w in _split(text)}
        self.order = {w: i for i, w in enumerate(sorted(tokens, key=lambda w: (frequency.get(w, 0), w)))}
        self.labels, self.sets, self.needs = [], [], []
        self.index: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
        for number, (text, label) in enumerate(templates):
            ordered = sorted(set(_split(text)), key=self.order.__getitem__)
            need = math.ceil(threshold * len(ordered) - 1e-9)
            self.labels.append(label)
            self.sets.append(frozenset(ordered))
            self.needs.append(need)
            for place, word in enumerate(ordered[: len(ordered) - need + 1]):
                self.index[word].append((number, place))
        self.rare = frozenset(self.index)
        # A template that begins just behind the start of a block must still end in it.
        self.block = max([BLOCK_WORDS, *(len(_split(text)) + BLOCK_STEP - 1 for text, _ in templates)])

    def matches(self, block: list[bytes]) -> dict[int, float]:
        """Containment by template, of those the block meets."""
        known = sorted({w for w in block if w in self.order}, key=self.order.__getitem__)
        tried, found = set(), {}
        for place, word in enumerate(known):
            for number, at in self.index.get(word, ()):
                if number in tried:
                    continue
                tried.add(number)
                size, need = len(self.sets[number]), self.needs[number]
                if min(size - at, len(known) - place) < need:
                    continue
                shared = len(self.sets[number].intersection(known))
                if shared >= need:
                    found[number] = shared / size
        return found


def _places(words: list[bytes], phrase: list[bytes]) -> list[int]:
    size, last = len(phrase), phrase[-1]
    return [
        i - size + 1
        for i, w in enumerate(words)
        if w == last and i >= size - 1 and words[i - size + 1 : i + 1] == phrase
    ]


def scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    *,
    phrases=PHRASES,
    templates=TEMPLATES,
    threshold: float = THRESHOLD,
    across_lines: bool = True,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, matches.

    ``matches`` holds (template, line, block, containment) of every block that
    contains at least ``threshold`` of a template's distinct words. Blocks of the whole
    text have null as their line; without ``across_lines`` they are left out, and wrapped
    notices are missed. Templates may be of any length; a longer one makes all blocks longer. The score
    is the largest containment found, 1 where a phrase stands, else 0. Null
    counts as empty: no words, no labels (empty strings), null places, score 0.
    Repeated rows and null ids are returned as they come; an empty table gives
    an empty result; other columns are not read.
    """
    spark = docs.sparkSession
    texts = docs.select(col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    tokens = frozenset(w for text, _ in templates for w in _split(text))

    def frequencies(batches):
        seen: Counter[bytes] = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                seen.update(tokens.intersection(_split(text)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], ["word", "n"]
        )

    # One row per template word and task: the words of the templates are few, whatever the texts.
    counted = texts.select("text").mapInArrow(frequencies, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    index = _Templates(templates, {bytes(r.word): r.n for r in counted.collect()}, threshold)
    wanted = [(_split(text), label) for text, label in phrases]

    def found(batches):
        for batch in batches:
            rows = [_scan(text, index, wanted, across_lines) for text in batch.column(1).to_pylist()]
            columns = [pa.array(list(c), f) for c, f in zip(zip(*rows, strict=True), _ARROW, strict=True)]
            if rows:
                yield pa.RecordBatch.from_arrays([batch.column(0), *columns], schema.names)

    schema = StructType([StructField("doc_id", texts.schema["doc_id"].dataType), *_RESULT])
    return texts.mapInArrow(found, schema)


_MATCH = {"template": (IntegerType(), pa.int32()), "line": (IntegerType(), pa.int32()), "block": (IntegerType(), pa.int32()), "containment": (DoubleType(), pa.float64())}
_RESULT = [
    StructField("n_words", LongType()), StructField("n_base", LongType()), StructField("first_word", LongType()),
    StructField("last_word", LongType()), StructField("base_labels", StringType()), StructField("labels", StringType()),
    StructField("score", DoubleType()), StructField("matches", ArrayType(StructType([StructField(n, t[0]) for n, t in _MATCH.items()]))),
]
_ARROW = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), pa.list_(pa.struct([(n, t[1]) for n, t in _MATCH.items()]))]


def _scan(text: str, index: _Templates, phrases, across_lines: bool) -> tuple:
    words = _split(text)
    present = frozenset(words) & (index.rare | {p[-1] for p, _ in phrases})
    places, base = [], set()
    for phrase, label in phrases:
        if phrase[-1] in present and (at := _places(words, phrase)):
            places += at
            base.add(label)
    matches = []
    if present & index.rare:
        for line_number, line in enumerate(text.split("\n")):
            line_words = _split(line)
            if index.rare.isdisjoint(line_words):
                continue
            for number, block in enumerate(_blocks(line_words, index.block)):
                matches += [
                    {"template": t, "line": line_number, "block": number, "containment": c}
                    for t, c in index.matches(block).items()
                ]
        if across_lines:
            for number, block in _blocks_with(words, index.block, index.rare):
                matches += [
                    {"template": t, "line": None, "block": number, "containment": c}
                    for t, c in index.matches(block).items()
                ]
    labels = base | {index.labels[m["template"]] for m in matches}
    score = max([float(bool(base)), *(m["containment"] for m in matches)])
    ends = (min(places), max(places)) if places else (None, None)
    return (len(words), len(places), *ends, ",".join(sorted(base)), ",".join(sorted(labels)), score, matches)
