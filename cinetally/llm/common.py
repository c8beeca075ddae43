"""What several operators of this subpackage share."""

from __future__ import annotations

import sys
from types import ModuleType

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cinetally.sources.scratch import Scratch

FILE, ROW = "_llm_file", "_llm_row"
BIT_COUNT = 24
#: Words of a bitmap in one row of it, as a power of two.
ROW_BITS = 6


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def col(name: str) -> Column:
    """A column by its literal name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def text_of(name: str) -> Column:
    """The text with null as empty."""
    return F.coalesce(col(name), F.lit(""))


def crc_mod(name: str, folds: int) -> Column:
    """Fold of a row by the CRC of its id as text; a null id counts as empty text."""
    return F.crc32(F.coalesce(col(name).cast("string"), F.lit("")).cast("binary")) % folds


def located(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """The rows with the file and the place in it that they come from.

    A frame that is not read from Parquet files is written first.
    """
    where = [F.col("_metadata.file_path").alias(FILE), F.col("_metadata.row_index").alias(ROW)]
    try:
        return docs.select("*", *where)
    except AnalysisException:
        return scratch.table(docs, "located").select("*", *where)


def without(rows: DataFrame, gone: DataFrame) -> DataFrame:
    """The located rows that are not among ``gone`` (file, row), as they were before ``located``."""
    return rows.join(gone, [FILE, ROW], "left_anti").drop(FILE, ROW)


def membership_bits(keys: DataFrame, key: Column, bit_count: int = BIT_COUNT) -> DataFrame:
    """A bitmap of the keys' hashes, in rows of 64 words of 64 bits.

    It never has more than 2**bit_count / 4096 rows, whatever the number of keys,
    which makes it safe to broadcast. With more keys it lets more rows pass. A row
    a word would be as many bits, but several times the memory once it is hashed.
    """
    place = F.pmod(F.xxhash64(key), F.lit(1 << bit_count))
    words = (
        keys.select(place.alias("p"))
        .groupBy(F.shiftright("p", 6).alias("word"))
        .agg(F.expr("bit_or(shiftleft(1L, cast(p % 64 as int)))").alias("mask"))
    )
    held = F.map_from_entries(F.collect_list(F.struct(_within("word").alias("at"), "mask")))
    rows = words.groupBy(F.shiftright("word", ROW_BITS).alias("_llm_line")).agg(held.alias("held"))
    return rows.select("_llm_line", F.expr(f"transform(sequence(0, {(1 << ROW_BITS) - 1}), i -> coalesce(held[i], 0L))").alias("_llm_words"))


def _within(word: str | Column) -> Column:
    return F.pmod(word, F.lit(1 << ROW_BITS)).cast("int")


def _looked_up(df: DataFrame, key: Column, bits: DataFrame, bit_count: int, how: str) -> DataFrame:
    place = F.pmod(F.xxhash64(key), F.lit(1 << bit_count))
    return df.withColumn("_llm_place", place).join(F.broadcast(bits), F.shiftright("_llm_place", 6 + ROW_BITS) == F.col("_llm_line"), how)


def _is_set() -> Column:
    word = F.col("_llm_words")[_within(F.shiftright("_llm_place", 6))]
    return F.getbit(word, F.pmod("_llm_place", F.lit(64)).cast("int")) == 1


def maybe_members(df: DataFrame, key: Column, bits: DataFrame, bit_count: int = BIT_COUNT) -> DataFrame:
    """The rows whose key may be among those of the bitmap: all that are, and few others."""
    return _looked_up(df, key, bits, bit_count, "inner").filter(_is_set()).drop("_llm_place", "_llm_line", "_llm_words")


def surely_others(df: DataFrame, key: Column, bits: DataFrame, bit_count: int = BIT_COUNT) -> DataFrame:
    """The rows that ``maybe_members`` leaves out: none of them is among the keys of the bitmap."""
    found = _looked_up(df, key, bits, bit_count, "left")
    return found.filter(~F.coalesce(_is_set(), F.lit(False))).drop("_llm_place", "_llm_line", "_llm_words")


def smallest_hashes(rows: DataFrame, key: str, wanted: int, total: int) -> DataFrame:
    """At most ``wanted`` of the ``total`` rows, those with the smallest hash of the key, whatever their order.

    Larger hashes go before the sort, so the task that puts the rows in order gets about as many as are wanted.
    """
    if total > wanted:
        last = -(1 << 63) + (1 << 64) * (wanted + 8 * int(wanted**0.5) + 8) // total
        rows = rows.filter(F.xxhash64(key) <= F.lit(min(last, (1 << 63) - 1)))
    return rows.orderBy(F.xxhash64(key), key).limit(wanted)


def worker_cache(owner: str) -> dict:
    """What a Python worker remembers for one operator, across its tasks.

    It remembers for one at a time: when tasks of another come, what it held goes,
    so that the caches of a stage are no burden to the stages behind it.
    """
    caches = sys.modules.setdefault("_llm_worker_cache", ModuleType("_llm_worker_cache"))
    if getattr(caches, "owner", None) != owner:
        caches.owner, caches.held = owner, {}
    return caches.held
