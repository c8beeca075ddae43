"""Bronze and silver scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from cinetally.schemas import SPECS, TableSpec

#: Column of the lines that do not parse.
UNPARSED = "_unparsed"
_LINE = "_line"


def read_bronze(
    spark: SparkSession,
    spec: TableSpec,
    path: str,
    *,
    infer: bool = False,
    strict_header: bool = True,
    rejects: bool = False,
    mode: str = "PERMISSIVE",
    **options: object,
) -> DataFrame:
    """Scan a headed CSV table.

    With the explicit schema a file whose header has other names or another
    order is refused; ``strict_header=False`` takes columns by position instead.
    ``infer=True`` leaves the types to Spark, at the price of one more pass
    over the files and of leading zeros in ids. Malformed fields become NULL
    in the default mode; with ``rejects`` the frame has one more column, ``UNPARSED``, with the
    line of a row that has a malformed field, or too few or too many fields, and NULL for the others: see
    ``parsed`` and ``rejected``. Quotes inside quoted fields are doubled; pass another
    ``escape`` for files that escape them otherwise.
    """
    reader = spark.read.options(**{"header": True, "mode": mode, "escape": '"', **options})
    if rejects:
        if infer or mode != "PERMISSIVE":
            raise ValueError("rejects need the explicit schema and the permissive mode")
        schema = T.StructType([*spec.schema, T.StructField(_LINE, T.StringType(), True)])
        reader = reader.option("columnNameOfCorruptRecord", _LINE).schema(schema)
        scanned = reader.option("enforceSchema", not strict_header).csv(path)
        # Fields that nobody asks for are not parsed, and their faults not seen. The
        # condition always holds; it asks for all fields wherever the line is used.
        whole = F.pmod(F.xxhash64(*spec.schema.fieldNames()), F.lit(2)) >= 0
        return scanned.select(*spec.schema.fieldNames(), F.when(whole, F.col(_LINE)).alias(UNPARSED))
    if infer:
        return reader.option("inferSchema", True).csv(path)
    return reader.schema(spec.schema).option("enforceSchema", not strict_header).csv(path)


def parsed(scanned: DataFrame) -> DataFrame:
    """The rows of a scan that were read whole."""
    return scanned.filter(F.col(UNPARSED).isNull()).drop(UNPARSED)


def rejected(scanned: DataFrame) -> DataFrame:
    """(line) of the rows that were not."""
    return scanned.filter(F.col(UNPARSED).isNotNull()).select(F.col(UNPARSED).alias("line"))


def read_silver(spark: SparkSession, folder: str, spec: TableSpec) -> DataFrame:
    """Scan one silver table; partition directories give the partition columns.

    The schema comes from the spec, so no footer is opened to find it and a
    table without rows can be read.
    """
    return spark.read.schema(spec.silver_schema()).parquet(f"{folder}/{spec.name}")


def read_silver_tables(
    spark: SparkSession, folder: str, specs: dict[str, TableSpec] = SPECS
) -> dict[str, DataFrame]:
    return {name: read_silver(spark, folder, spec) for name, spec in specs.items()}
