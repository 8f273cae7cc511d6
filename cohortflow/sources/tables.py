"""Sources and sinks.

Raw tables are read with fixed schemas (never inferred), by logical name;
NA tokens map to NULL at the scan. Derived datasets are written partitioned
by ``cutoff`` so a reader of one cutoff prunes the others.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortflow.operators.cutoffs import day_of
from cohortflow.schemas import RAW_SCHEMAS, TABLE_FILES

# Cells that pandas reads as missing by default.
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
    "NULL", "NaN", "None", "n/a", "nan", "null",
]


class MissingTableError(FileNotFoundError):
    pass


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


class MissingColumnError(ValueError):
    pass


def _raw_cells(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The file's cells as strings, its columns bound by header name (files may
    order them in any way or carry more)."""
    raw = (
        spark.read.option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("enforceSchema", False)
        .csv(path)
    )
    if absent := [f.name for f in schema if f.name not in raw.columns]:
        raise MissingColumnError(f"{path} has no columns {absent}; its header is {raw.columns}")
    return raw.select(*[F.col(f"`{f.name}`") for f in schema])


def _known(name: str, null_token: str) -> Column:
    """The cell, or NULL where it is ``null_token`` or an NA token."""
    c = F.col(f"`{name}`")
    return F.when(~c.isin([null_token, *NA_TOKENS]), c)


def read_csv_table(
    spark: SparkSession, path: str, name: str, null_token: str = "?", schema: T.StructType | None = None
) -> DataFrame:
    """S1 + S2 for one table: header CSV bound by name, NA tokens of any column
    (numeric ones too) as NULL, then the fixed schema's types. A cell that is
    neither missing nor of its type fails the query with its column."""
    schema = schema or RAW_SCHEMAS[name]
    out = []
    for f in schema:
        known = _known(f.name, null_token)
        typed = known.try_cast(f.dataType)
        bad = known.isNotNull() & typed.isNull()
        message = F.concat(F.lit(f"{name}.{f.name}: not a {f.dataType.simpleString()}: "), known)
        out.append(F.when(bad, F.raise_error(message).cast(f.dataType)).otherwise(typed).alias(f.name))
    return _raw_cells(spark, path, schema).select(*out)


def bad_cells(spark: SparkSession, path: str, name: str, null_token: str = "?", schema: T.StructType | None = None) -> DataFrame:
    """Per column of a CSV table: cells read as missing, and cells that are
    neither missing nor of the column's type."""
    schema = schema or RAW_SCHEMAS[name]
    aggs = []
    for f in schema:
        known = _known(f.name, null_token)
        missing = F.count_if(known.isNull()).alias("missing_cells")
        bad = F.count_if(known.isNotNull() & known.try_cast(f.dataType).isNull()).alias("bad_cells")
        aggs.append(F.struct(F.lit(f.name).alias("column"), missing, bad))
    return _raw_cells(spark, path, schema).agg(F.array(*aggs).alias("c")).select(F.lit(name).alias("table"), F.inline("c"))


def load_tables(
    spark: SparkSession,
    directory: str,
    files: Mapping[str, str] = TABLE_FILES,
    fmt: str = "csv",
    null_token: str = "?",
) -> dict[str, DataFrame]:
    """Every logical table by name; raises if one is absent."""
    out = {}
    for name, filename in files.items():
        path = os.path.join(directory, filename if fmt == "csv" else name)
        if not _exists(spark, path):
            raise MissingTableError(f"Missing expected table: {path}")
        if fmt == "csv":
            out[name] = read_csv_table(spark, path, name, null_token)
        else:
            out[name] = spark.read.schema(RAW_SCHEMAS[name]).parquet(path)
    return out


def write_tables_csv(tables: Mapping[str, DataFrame], directory: str, null_token: str = "?") -> None:
    """Write tables as header CSV with ``null_token`` for NULL (the format of
    the official distribution)."""
    for name, df in tables.items():
        df.write.mode("overwrite").option("header", True).option("nullValue", null_token).option(
            "ignoreLeadingWhiteSpace", False
        ).option("ignoreTrailingWhiteSpace", False).csv(
            os.path.join(directory, TABLE_FILES[name])
        )


def write_by_cutoff(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Write a long-by-cutoff matrix partitioned by ``cutoff``. Only the
    cutoffs that ``df`` has are replaced: one cutoff can be rebuilt while the
    files of the others stay as they are."""
    writer = df.write.mode("overwrite").partitionBy("cutoff").format(fmt).option("header", True)
    writer.option("partitionOverwriteMode", "dynamic").save(path)


def write_bucketed(df: DataFrame, path: str, key: Sequence[str], buckets: int | None = None) -> DataFrame:
    """Write ``df`` in sorted buckets of ``key`` under ``path`` and read it as
    a bucketed table. As many buckets as shuffle partitions (the default) join
    and group by ``key`` without an exchange."""
    spark = df.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"bucketed_{uuid.uuid4().hex}"
    # a task writes one bucket, so a bucket is one file
    df.repartition(n, *key).write.bucketBy(n, *key).sortBy(*key).option("path", path).saveAsTable(name)
    return spark.table(name)


def write_evidence(evidence: Mapping[str, DataFrame], directory: str) -> DataFrame:
    """One header CSV folder per evidence table, and a manifest of them with
    their rows, counted while they are written."""
    rows = []
    for name, df in evidence.items():
        seen = Observation()
        counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
        counted.write.mode("overwrite").option("header", True).option("emptyValue", "").csv(os.path.join(directory, f"{name}.csv"))
        rows.append((name, seen.get["rows"], ",".join(df.columns)))
    spark = next(iter(evidence.values())).sparkSession
    manifest = spark.createDataFrame(rows, "evidence string, rows long, columns string")
    manifest.coalesce(1).write.mode("overwrite").option("header", True).csv(os.path.join(directory, "manifest.csv"))
    return manifest


def read_evidence(spark: SparkSession, directory: str, schemas: Mapping[str, T.StructType]) -> dict[str, DataFrame]:
    """The evidence tables that the manifest of a folder names."""
    manifest = spark.read.option("header", True).csv(os.path.join(directory, "manifest.csv"))
    names = [r.evidence for r in manifest.collect()]
    return {n: spark.read.schema(schemas[n]).option("header", True).csv(os.path.join(directory, f"{n}.csv")) for n in names}


def read_cutoff(spark: SparkSession, path: str, cutoff: str) -> DataFrame:
    """Read one cutoff of a derived dataset (partition pruning)."""
    return spark.read.parquet(path).where(F.col("cutoff") == cutoff)


def write_model_results(summary: DataFrame, path: str) -> None:
    """Model results in order of cutoff day and model. A row a cutoff and
    model, so one file holds them all in order."""
    ordered = summary.orderBy(day_of(), "cutoff", "model").coalesce(1)
    ordered.write.mode("overwrite").option("header", True).csv(path)


def csv_roundtrip(tables: Mapping[str, DataFrame], directory: str, null_token: str = "?") -> dict[str, DataFrame]:
    """Write the tables as CSV with ``null_token`` for NULL and read them back
    with their own schemas (D1 input: a second source of the same data)."""
    write_tables_csv(tables, directory, null_token)
    spark = next(iter(tables.values())).sparkSession
    return {
        name: read_csv_table(spark, os.path.join(directory, TABLE_FILES[name]), name, null_token, schema=df.schema)
        for name, df in tables.items()
    }
