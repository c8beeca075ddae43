"""Bitmaps of keys, and what a worker remembers."""

from pyspark.sql import functions as F

from cinetally.llm import common


def test_bitmaps_have_few_rows_and_the_same_bits(spark):
    keys, others = spark.range(30_000), spark.range(1_000_000, 1_030_000)
    bits = common.membership_bits(keys, F.col("id"))
    assert bits.count() <= 2**common.BIT_COUNT // 64 // 64
    assert sorted(r.id for r in common.maybe_members(keys, F.col("id"), bits).collect()) == list(range(30_000))
    assert common.maybe_members(others, F.col("id"), bits).count() < 200
    both = keys.unionByName(others)
    assert common.surely_others(both, F.col("id"), bits).count() + common.maybe_members(both, F.col("id"), bits).count() == 60_000
    place = "pmod(xxhash64(id), 1 << 24)"
    words = {r.w: r.m for r in keys.groupBy(F.expr(f"shiftright({place}, 6)").alias("w")).agg(F.expr(f"bit_or(shiftleft(1L, cast({place} % 64 as int)))").alias("m")).collect()}
    packed = {r._llm_line * 64 + i: w for r in bits.collect() for i, w in enumerate(r._llm_words) if w}
    assert packed == words
    assert common.maybe_members(keys, F.col("id"), common.membership_bits(keys.limit(0), F.col("id"))).isEmpty()
    assert common.surely_others(keys, F.col("id"), common.membership_bits(keys.limit(0), F.col("id"))).count() == 30_000


def test_a_worker_remembers_for_one_operator():
    first = common.worker_cache("one")
    first["a"] = 1
    assert common.worker_cache("one") is first
    assert common.worker_cache("two") == {} and common.worker_cache("one") == {}
