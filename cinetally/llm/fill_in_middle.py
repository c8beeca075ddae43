"""Fill-in-the-middle texts by one regular expression with counted quantifiers.

A text of n units is cut behind its a-th and its b-th unit. The pattern is made
for each row: a possessive group takes exactly a units, another one b - a, the
rest is the suffix; one match gives all three and its replacement is the new
text. Possessive groups never give a unit back, so the matcher counts in a loop
and needs no stack, however long the text is.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from cinetally.llm.common import col, text_of

#: A run of ASCII letters, or any other single character.
UNIT = "[A-Za-z]+|[^A-Za-z]"


@dataclass(frozen=True)
class Marks:
    """What stands before the prefix, the suffix and the middle."""

    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    def __post_init__(self) -> None:
        every = self.every()
        if not all(every) or len(set(every)) < 3:
            raise ValueError("the marks must be three different texts")
        # Else a mark could begin in a text and end in the mark behind it.
        if any(a != b and a in b for a in every for b in every) or any(
            a.endswith(b[:k]) for a in every for b in every for k in range(1, min(len(a), len(b)) + 1) if a != b or k < len(a)
        ):
            raise ValueError("no mark may begin as another one, or itself, ends")

    def every(self) -> tuple[str, str, str]:
        return self.prefix, self.suffix, self.middle


MARKS = Marks()


def _replacement(*parts: str | int) -> str:
    return "".join(f"${p}" if isinstance(p, int) else p.replace("\\", "\\\\").replace("$", "\\$") for p in parts)


def cut_pattern(units: str, first: Column, second: Column) -> Column:
    """A pattern whose groups are the first ``first`` units, the next ``second`` and all the rest."""
    unit = f"(?:{units})"
    return F.concat(
        F.lit(f"(?s)\\A((?:{unit}){{"), first.cast("string"), F.lit(f"}}+)((?:{unit}){{"), second.cast("string"), F.lit("}+)(.*)\\z")
    )


def _digits(id_col: str, seed: str) -> list[Column]:
    """Four numbers of 32 bits from the digest of seed and id; a null id counts as empty."""
    digest = F.sha2(F.concat(F.lit(seed), F.coalesce(col(id_col).cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("bigint") for i in range(4)]


def transform(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    *,
    seed: str = "1:",
    plain_percent: int = 10,
    spm_percent: int = 20,
    units: str = UNIT,
    marks: Marks = MARKS,
) -> DataFrame:
    """One row per row: doc_id, n, form, prefix_chars, middle_chars, output.

    ``units`` is a pattern whose matches, from left to right, cover every text.
    Cuts and form come from the digest of ``seed`` and id, so equal ids are cut
    alike if their texts have equally many units, and no order or partition
    matters. A text stays as it is (``plain``, counts of characters null) in
    ``plain_percent`` of the rows, where it is null or empty, and where it
    holds a mark; of the others ``spm_percent`` begin with the suffix (``spm``)
    and the rest with the prefix (``psm``). A null id counts as empty;
    repeated rows stay repeated; an empty table gives an empty result; other
    columns are not read. Equal cuts leave the middle empty.
    """
    h1, h2, h3, h4 = _digits(id_col, seed)
    rows = docs.select(col(id_col).alias("doc_id"), text_of(text_col).alias("t"), h1.alias("h1"), h2.alias("h2"), h3.alias("h3"), h4.alias("h4"))
    rows = rows.withColumn("n", F.regexp_count("t", F.lit(units)).cast("bigint"))
    whole = (F.col("t") == "") | (F.col("h3") % 100 >= 100 - plain_percent)
    for mark in marks.every():
        whole = whole | F.contains("t", F.lit(mark))
    rows = rows.select(
        "doc_id", "t", "n",
        F.least(F.col("h1") % (F.col("n") + 1), F.col("h2") % (F.col("n") + 1)).alias("a"),
        F.greatest(F.col("h1") % (F.col("n") + 1), F.col("h2") % (F.col("n") + 1)).alias("b"),
        F.when(whole, "plain").when(F.col("h4") % 100 < spm_percent, "spm").otherwise("psm").alias("form"),
    )
    p, s, m = marks.every()
    order = F.when(F.col("form") == "spm", _replacement(s, 3, p, 1, m, 2)).otherwise(_replacement(p, 1, s, 3, m, 2))
    moved = F.regexp_replace("t", cut_pattern(units, F.col("a"), F.col("b") - F.col("a")), order)
    rows = rows.select("doc_id", "n", "form", F.when(F.col("form") == "plain", F.col("t")).otherwise(moved).alias("output"))

    def place(mark: str) -> Column:
        """Characters before the mark; it occurs once."""
        return F.locate(mark, F.col("output")) - 1

    prefix = F.when(F.col("form") == "psm", place(s) - len(p)).when(F.col("form") == "spm", place(m) - place(p) - len(p))
    middle = F.when(F.col("form") != "plain", F.length("output") - place(m) - len(m))
    return rows.select("doc_id", "n", "form", prefix.cast("bigint").alias("prefix_chars"), middle.cast("bigint").alias("middle_chars"), "output")


def restored(output: Column, form: Column, marks: Marks = MARKS) -> Column:
    """The text as it was, from output and form alone; null where one of them is null."""
    p, s, m = map(re.escape, marks.every())
    psm = F.regexp_replace(output, F.lit(f"(?s)\\A{p}(.*?){s}(.*?){m}(.*)\\z"), F.lit("$1$3$2"))
    spm = F.regexp_replace(output, F.lit(f"(?s)\\A{s}(.*?){p}(.*?){m}(.*)\\z"), F.lit("$2$3$1"))
    return F.when(form == "psm", psm).when(form == "spm", spm).when(form == "plain", output)


def digests(cut: DataFrame, marks: Marks = MARKS) -> DataFrame:
    """The rows of ``transform`` with digests of the output and of the text rebuilt from it, in place of the output."""
    rebuilt = restored(F.col("output"), F.col("form"), marks)
    return cut.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"), F.sha2(rebuilt.cast("binary"), 256).alias("restored_sha256"),
    )
