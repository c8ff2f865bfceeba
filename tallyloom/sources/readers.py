"""Reading and writing named tables, stacked sources, CSV and JSON of monthly records, and outputs for each entity."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the folder that all executors share; in local mode a temporary folder where none is set."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root}/scratch/{name}-{uuid.uuid4().hex}"


def load_named(spark: SparkSession, folder: str, names: list[str]) -> dict[str, DataFrame]:
    """The tables that are there; dates and local timestamps become timestamps. Missing ones are left out."""
    out = {}
    for name in names:
        try:
            rows = spark.read.parquet(f"{folder}/{name}.parquet")
        except AnalysisException as e:
            if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            continue
        out[name] = rows.withColumns({c: F.col(c).cast("timestamp") for c, t in rows.dtypes if t in ("date", "timestamp_ntz")})
    return out


def stacked(spark: SparkSession, globs: dict[str, str], columns: dict[str, Column] | None = None, formats: dict[str, str] | None = None, schemas: dict[str, str] | None = None) -> DataFrame:
    """All files of each source's glob, with `source` and `file`; columns that a source lacks are null.

    A source's format is Parquet unless `formats` names another that Spark reads, such as csv (with a header line) or
    json; `schemas` has the columns of those, else they are inferred, which reads the files once more.

    Of files whose names differ in case only the first by name counts. A source without files is left out, unreadable
    files are skipped, and it is an error if no source has any.
    """
    found = []
    for source, glob in globs.items():
        try:
            reader = spark.read.format((formats or {}).get(source, "parquet")).option("ignoreCorruptFiles", "true").option("ignoreMissingFiles", "true").option("header", "true")
            rows = (reader.schema(schemas[source]) if source in (schemas or {}) else reader).load(glob)
        except AnalysisException as e:
            if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA", "FAILED_READ_FILE.NO_HINT"):
                raise
            continue
        rows = rows.select("*", F.lit(source).alias("source"), F.col("_metadata.file_path").alias("file"))
        first = rows.groupBy(F.lower("file").alias("_low")).agg(F.min("file").alias("file")).select("file")
        found.append(rows.join(first, "file", "left_semi"))
    if not found:
        raise ValueError(f"no files in any of {sorted(globs)}")
    out = found[0]
    for rows in found[1:]:
        out = out.unionByName(rows, allowMissingColumns=True)
    return out.select("source", "file", *(c.alias(n) for n, c in columns.items())) if columns else out


def monthly_table(spark: SparkSession, path: str, schema: str, month: str) -> DataFrame:
    """A table of monthly rows from Parquet or, by its suffix, CSV with a header; the month becomes its first day."""
    rows = spark.read.schema(schema).option("header", "true").csv(path) if path.rstrip("/").endswith(".csv") else spark.read.schema(schema).parquet(path)
    return rows.withColumn(month, F.trunc(month, "MM"))


def monthly_records(spark: SparkSession, path: str, schema: str, date: str = "date") -> DataFrame:
    """Records of JSON arrays; those without a date are left out."""
    return spark.read.schema(schema).option("multiLine", "true").json(path).filter(F.col(date).isNotNull())


def write_both(rows: DataFrame, path: str) -> tuple[str, str]:
    """rows as Parquet and as CSV with a header; the two paths."""
    rows.write.mode("overwrite").parquet(f"{path}.parquet")
    rows.write.mode("overwrite").option("header", "true").csv(f"{path}.csv")
    return f"{path}.parquet", f"{path}.csv"


def slug(name: Column) -> Column:
    """A name as part of a path: lower case, spaces and slashes to underscores, no dots."""
    return F.replace(F.translate(F.lower(name), " /", "__"), F.lit("."), F.lit(""))


def write_entities(rows: DataFrame, path: str, kind: str, entity: str) -> str:
    """A folder for each kind and entity, one shuffle by both."""
    out = rows.withColumn(f"{entity}_slug", slug(F.col(entity)))
    out.repartition(kind, f"{entity}_slug").write.mode("overwrite").partitionBy(kind, f"{entity}_slug").parquet(path)
    return path
