"""Exact de-duplication by a streaming query with disk-backed keyed state.

The stream keeps one state row per digest, in RocksDB and without expiry: the
stable identifier and the locator (file, row) of the first copy, and how many
copies there were. Copies are combined in each task before they reach the
state, so a text with a third of all rows is one row per task there. Digests
that were hit more than once are then checked against the full bytes.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cinetally.llm.common import FILE, ROW, col, located, maybe_members, membership_bits, text_of, without
from cinetally.sources.scratch import Scratch

WHITE_SPACE = r"[\x20\x09-\x0D]+"
BATCH_BYTES = 16 << 30
#: State on disk, and closed at the end of each task: the tables that RocksDB
#: sets aside (4 MB a partition at least) do not outlive the tasks that use them.
_STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",
}


def normalized(text: Column) -> Column:
    return F.regexp_replace(text, WHITE_SPACE, " ")


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


@contextmanager
def _disk_backed_state(spark: SparkSession):
    before = {key: spark.conf.get(key) for key in _STATE_STORE}
    for key, value in _STATE_STORE.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def _keyed_state(spark: SparkSession, staged: DataFrame, source: str, work: Scratch, batch_bytes: int) -> DataFrame:
    """Run the stream over the staged digests; its final state as (digest, first, copies)."""
    checkpoint = work.path("stream")
    with _disk_backed_state(spark):
        query = (
            spark.readStream.schema(staged.schema)
            .option("maxBytesPerTrigger", batch_bytes)
            .parquet(source)
            .groupBy("digest")
            .agg(F.min("first").alias("first"), F.count(F.lit(1)).alias("copies"))
            .writeStream.outputMode("update")
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .format("noop")
            .start()
        )
        query.awaitTermination()
        state = spark.read.format("statestore").load(checkpoint)
        first, copies = (f"value.`{f.name}`" for f in state.schema["value"].dataType.fields)
        return work.table(
            state.select(F.col("key.digest").alias("digest"), F.col(first).alias("first"), F.col(copies).alias("copies")),
            "state",
        )


def decisions(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    *,
    digest=sha256,
    batch_bytes: int = BATCH_BYTES,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256, file, row.

    Texts are equal when they are after each run of white space became one
    space; null counts as empty, and all empty texts form one group. The row
    with the smallest id stays; null ids come last, and between equal ids the
    place in the files decides, so one row of each group stays. An empty
    table gives an empty result. Other columns are neither read nor returned.

    ``digest`` may be weaker than SHA-256: texts that share a digest but
    differ in a byte are told apart.
    """
    work = Scratch(docs.sparkSession)
    return _decide(located(docs, work), id_col, text_col, digest, batch_bytes, work)


def _decide(rows: DataFrame, id_col: str, text_col: str, digest, batch_bytes: int, work: Scratch) -> DataFrame:
    spark = rows.sparkSession
    first = F.struct(
        col(id_col).isNull().alias("no_id"), col(id_col).alias("id"), F.col(FILE).alias("file"), F.col(ROW).alias("row")
    )
    rows = rows.select(first.alias("first"), normalized(text_of(text_col)).alias("text"))
    rows = rows.select(digest(F.col("text")).alias("digest"), "first", "text")

    sources = work.path("staged")
    shown = F.lower(F.hex(sha256(F.col("text"))))
    rows.select("digest", "first", shown.alias("text_sha256")).write.parquet(sources)
    staged = spark.read.parquet(sources)
    state = _keyed_state(spark, staged.select("digest", "first"), sources, work, batch_bytes)

    grouped = staged.join(state.withColumnRenamed("first", "keep"), "digest")
    differing = _differing_digests(rows, state, work)
    if not differing.isEmpty():
        grouped = _regrouped(rows, grouped, differing)
    kept = F.col("first") == F.col("keep")
    return grouped.select(
        F.col("first.id").alias("doc_id"),
        F.col("keep.id").alias("keep_id"),
        F.col("copies").alias("group_size"),
        kept.alias("kept"),
        "text_sha256",
        F.col("first.file").alias("file"),
        F.col("first.row").alias("row"),
    )


def _differing_digests(rows: DataFrame, state: DataFrame, work: Scratch) -> DataFrame:
    """Digests under which not all texts have the bytes of the first one.

    Only rows whose digest was hit are shuffled. The first copies are found by
    locator and written, so that the comparison is a plain join whose hot
    digests adaptive execution splits.
    """
    hit = state.filter("copies > 1")
    place = F.struct("first.file", "first.row")
    # An inner join: a semi join would be pushed below the one with the bitmap, and shuffle all texts.
    firsts = maybe_members(rows, place, membership_bits(hit, place)).join(hit.select("first"), "first")
    firsts = work.table(firsts.select("digest", F.col("text").alias("first_text")), "firsts")
    copies = maybe_members(rows, F.col("digest"), membership_bits(hit, F.col("digest")))
    different = copies.join(firsts, "digest").filter("text != first_text")
    # Written before they are made distinct: an aggregate above would keep the join from splitting hot digests.
    return work.table(different.select("digest"), "different").distinct()


def _regrouped(rows: DataFrame, grouped: DataFrame, differing: DataFrame) -> DataFrame:
    """Groups by the text itself for the digests that do not tell texts apart."""
    shared = rows.join(differing, "digest", "left_semi")
    by_text = shared.groupBy("text").agg(F.min("first").alias("keep"), F.count(F.lit(1)).alias("copies"))
    again = shared.join(by_text, "text").select(
        "digest", "first", F.lower(F.hex(sha256(F.col("text")))).alias("text_sha256"), "keep", "copies"
    )
    return grouped.join(differing, "digest", "left_anti").unionByName(again)


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; see ``decisions``."""
    work = Scratch(docs.sparkSession)
    rows = located(docs, work)
    gone = _decide(rows, id_col, text_col, sha256, BATCH_BYTES, work).filter("not kept")
    gone = work.table(gone.select(F.col("file").alias(FILE), F.col("row").alias(ROW)), "gone")
    return without(rows, gone)
