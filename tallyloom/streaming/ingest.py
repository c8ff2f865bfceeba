"""Incremental ingestion: the streaming forms of de-duplication, rollup, upsert and status."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def event_stream(spark: SparkSession, path: str, schema, files_per_trigger: int = 1) -> DataFrame:
    """New files under path; local timestamps become instants, which watermarks need."""
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)
    return rows.withColumns({c: F.col(c).cast("timestamp") for c, t in rows.dtypes if t == "timestamp_ntz"})


def first_of_each(stream: DataFrame, key: list[str], at: str, late: str = "2 days") -> DataFrame:
    """The first row of each key; state is dropped behind the watermark."""
    return stream.withWatermark(at, late).dropDuplicatesWithinWatermark(key)


def daily_rollup(stream: DataFrame, at: str, key: str, value: str, late: str = "1 day") -> DataFrame:
    """(day, key, n, total) of closed days; rows behind the watermark are dropped."""
    day = F.window(at, "1 day")
    return stream.withWatermark(at, late).groupBy(day.alias("w"), key).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(value).cast("decimal(18,2)")).alias("total")).select(F.col("w.start").cast("date").alias("day"), key, "n", "total")


def run_once(df: DataFrame, name: str, checkpoint: str, mode: str = "append") -> DataFrame:
    """All that is there now, into a table in memory (for tests and small outputs)."""
    df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return df.sparkSession.table(name)


def monthly_rollup(stream: DataFrame, at: str, key: str, value: str, late: str = "62 days") -> DataFrame:
    """(month, key, n, total) so far, for update mode: a month's state is dropped `late` after its first day is behind the latest month's; later rows of it are lost."""
    rows = stream.withColumn("month", F.date_trunc("month", at)).withWatermark("month", late)
    return rows.groupBy("month", key).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(value).cast("decimal(18,2)")).alias("total"))


#: Rows of a bucket of an upserted table.
BUCKET_ROWS = 1_000_000


class Upserted:
    """A table of the latest row of each key, as versions of buckets: version=V/bucket=B under `data`, and a manifest for each version.

    A manifest names the version that holds each bucket. It is written after the version's files and counts when it is
    whole, so a reader sees a batch wholly or not at all, and a batch that failed leaves nothing that anyone reads. The
    versions of the last two manifests are kept, for readers that have just begun.
    """

    def __init__(self, spark: SparkSession, target: str, bucket_rows: int = BUCKET_ROWS):
        self.spark, self.target, self.bucket_rows = spark, target.rstrip("/"), bucket_rows

    def _folders(self, name: str) -> list[str]:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.target}/{name}")
        files = path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())
        return [f.getPath().getName() for f in files.listStatus(path)] if files.exists(path) else []

    def _whole(self, version: int) -> bool:
        return "_SUCCESS" in self._folders(f"manifest/{version}")

    def versions(self) -> list[int]:
        return sorted(v for v in map(int, self._folders("manifest")) if self._whole(v))

    def manifest(self, version: int | None = None) -> DataFrame | None:
        """(bucket, version, n, buckets): a row for each bucket; None before the first batch."""
        known = self.versions()
        if not known:
            return None
        return self.spark.read.schema("bucket int, version int, n long, buckets int").parquet(f"{self.target}/manifest/{known[-1] if version is None else version}")

    def rows(self, schema, buckets: DataFrame | None = None) -> DataFrame:
        """The table, or its rows in the given buckets; empty before the first batch. schema: its columns and types."""
        named = self.manifest()
        if named is None:
            return self.spark.createDataFrame([], schema)
        if buckets is not None:
            named = named.join(buckets, "bucket", "left_semi")
        data = self.spark.read.schema(schema).option("basePath", f"{self.target}/data").parquet(f"{self.target}/data")
        return data.join(F.broadcast(named.select("bucket", "version")), ["bucket", "version"], "left_semi").select(*schema.fieldNames())  # one row a bucket, of bucket_rows each

    def merge(self, batch: DataFrame, keys: list[str], at: str) -> None:
        """Takes in a batch: of each key the latest row stays, of equal times that with the greatest values; a batch that is run again changes nothing.

        Only the buckets of the batch's keys are written again. Their number doubles, and all are dealt anew, when they
        would hold more than `bucket_rows` rows each.
        """
        rest = [c for c in batch.columns if c not in keys]
        winner = F.max_by(F.struct(*rest), F.struct(at, *rest)).alias("_r")
        batch = batch.groupBy(*keys).agg(winner).select(*keys, "_r.*").persist()
        try:
            more, known = batch.count(), self.manifest()
            if not more and known is not None:
                return
            held, buckets = known.agg(F.sum("n"), F.max("buckets")).first() if known is not None else (0, 1)
            wanted = buckets
            while wanted * self.bucket_rows < held + more:
                wanted *= 2
            bucket = F.pmod(F.xxhash64(*keys), F.lit(wanted)).cast("int")
            touched = None if wanted != buckets else batch.select(bucket.alias("bucket")).distinct()
            rows = batch.unionByName(self.rows(batch.schema, touched))
            latest = rows.groupBy(*keys).agg(winner).select(*keys, "_r.*").withColumn("bucket", bucket)
            version = (self.versions() or [0])[-1] + 1
            latest.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.target}/data/version={version}")
            written = self.spark.read.schema(latest.schema).option("basePath", f"{self.target}/data/version={version}").parquet(f"{self.target}/data/version={version}")
            manifest = written.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).select("bucket", F.lit(version).alias("version"), "n", F.lit(wanted).alias("buckets"))
            if touched is not None and known is not None:
                manifest = manifest.unionByName(known.join(manifest.select("bucket"), "bucket", "left_anti"))
            manifest.coalesce(1).write.mode("overwrite").parquet(f"{self.target}/manifest/{version}")
        finally:
            batch.unpersist()
        self._let_go()

    def _let_go(self) -> None:
        """Deletes versions that neither of the last two manifests names."""
        last = self.versions()[-2:]
        used = {r.version for v in last for r in self.manifest(v).select("version").distinct().collect()}  # one row a version in use
        for folder in [f"data/{n}" for n in self._folders("data") if n.startswith("version=") and int(n[8:]) not in used and int(n[8:]) <= last[-1]] + [f"manifest/{n}" for n in self._folders("manifest") if int(n) < last[0]]:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.target}/{folder}")
            path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def upsert_stream(stream: DataFrame, target: str, keys: list[str], at: str, checkpoint: str, bucket_rows: int = BUCKET_ROWS, mode: str = "append") -> DataFrame:
    """Merges all that is there now into the table under target, a micro-batch at a time, and gives the table. Null keys are keys like others."""
    schema = stream.schema

    def write(batch: DataFrame, number: int) -> None:
        Upserted(batch.sparkSession, target, bucket_rows).merge(batch, keys, at)

    stream.writeStream.foreachBatch(write).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return Upserted(stream.sparkSession, target, bucket_rows).rows(schema)


def to_files(stream: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """All that is there now, appended to Parquet files."""
    stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(path)
