"""Word shingles as arrays of hashes, in built-in functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

#: Everything in ASCII but letters and digits separates words.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _spaced(rows: DataFrame, *keys: str) -> DataFrame:
    """The keys and ``spaced``, the lower-case words of ``text`` with one space between them."""
    return rows.select(*keys, F.btrim(F.regexp_replace(F.lower("text"), SEPARATORS, " ")).alias("spaced"))


_WORDS = "CASE WHEN spaced = '' THEN cast(array() AS array<string>) ELSE split(spaced, ' ') END"


def word_hashes(rows: DataFrame, *keys: str) -> DataFrame:
    """The keys and ``h``, the hashes of the lower-case words of ``text``, in order."""
    # Column by column: an expression that is used in a lambda would be computed for each element.
    return _spaced(rows, *keys).select(*keys, F.expr(f"transform({_WORDS}, w -> xxhash64(w))").alias("h"))


def shingles_of(hashes: str, size: int) -> str:
    """SQL for the hashes of all runs of ``size`` words, from the words' hashes; none for shorter texts."""
    run = ", ".join(f"{hashes}[i + {k}]" for k in range(size))
    return f"""CASE WHEN size({hashes}) >= {size}
        THEN transform(sequence(0, size({hashes}) - {size}), i -> xxhash64({size}, {run}))
        ELSE cast(array() AS array<bigint>) END"""


def shingles_or_whole(hashes: str, size: int) -> str:
    """The same, but texts of fewer words have the one shingle of all their words."""
    short = " ".join(f"WHEN {k} THEN {shingles_of(hashes, k)}" for k in range(1, size))
    return f"CASE least(size({hashes}), {size}) {short} ELSE {shingles_of(hashes, size)} END"


def shingle_arrays(rows: DataFrame, *keys: str, size: int) -> DataFrame:
    """The keys, ``digest`` of a text's words and ``shingles``, with repetitions."""
    hashed = _spaced(rows, *keys).select(
        *keys, F.unhex(F.sha2(F.col("spaced").cast("binary"), 256)).alias("digest"), F.expr(f"transform({_WORDS}, w -> xxhash64(w))").alias("h")
    )
    return hashed.select(*keys, "digest", F.expr(shingles_or_whole("h", size)).alias("shingles"))
