"""Keyed tables for readers: upserts, latest status, comparison tables and nested exports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def upserted(old: DataFrame, new: DataFrame, keys: list[str], order: str) -> DataFrame:
    """old with new's rows in place of those with equal keys (null keys are equal); of a batch's rows for one key the last in `order` counts."""
    rest = [c for c in old.columns if c not in keys]
    rows = old.withColumn("_new", F.lit(0)).withColumn("_at", F.lit(None).cast(new.schema[order].dataType)).unionByName(new.select(*old.columns, F.lit(1).alias("_new"), F.col(order).alias("_at")))
    best = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct("_new", "_at", *rest)).alias("_best"))
    return best.select(*keys, *(F.col(f"_best.{c}").alias(c) for c in rest))


def latest(runs: DataFrame, groups: DataFrame, key: str, at: str) -> DataFrame:
    """The last run of each group; groups without one are "never_run"."""
    last = runs.groupBy(key).agg(F.max_by(F.struct("status", at), at).alias("_l"), F.count(F.lit(1)).alias("n_runs"))
    return groups.join(last, key, "left").select(key, F.coalesce("_l.status", F.lit("never_run")).alias("status"), F.col(f"_l.{at}").alias(at), F.coalesce("n_runs", F.lit(0)).alias("n_runs"))


def comparison(rows: DataFrame, month: str, entity: str, value: str, entities: list[str]) -> DataFrame:
    """A column for each of the given entities, a row for each month."""
    return rows.groupBy(month).pivot(entity, entities).agg(F.first(value))


def nested_export(rows: DataFrame, key: str, month: str, columns: list[str]) -> DataFrame:
    """For each key a JSON object of arrays in order of the month, all of one length."""
    listed = rows.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(month, *columns))).alias("_r"))
    field = lambda c: F.transform("_r", lambda x: x[c]).alias(c)
    arrays = [field(c) for c in (month, *columns)]
    return listed.select(key, F.to_json(F.struct(*arrays), {"ignoreNullFields": "false"}).alias("payload"))


def months_behind(runs: DataFrame, key: str, at: str, today: Column, late_days: int = 62) -> DataFrame:
    """(key, last, expected, months_behind): how far a source's last month is behind the one expected, that of `late_days` before this month."""
    expected = F.trunc(F.date_sub(F.trunc(today, "MM"), late_days), "MM")
    last = runs.groupBy(key).agg(F.trunc(F.max(at), "MM").alias("last")).withColumn("expected", expected)
    return last.withColumn("months_behind", F.greatest(F.lit(0), F.months_between("expected", "last").cast("int")))


def combined_hash(content: DataFrame, group: str, path: str, text: str, known: DataFrame) -> DataFrame:
    """(group, hash, verdict): one hash over a group's contents in the order of their paths; "re-run" if it is the ledger's last, else "new"."""
    one = content.select(group, F.struct(path, F.sha2(F.coalesce(text, F.lit("")), 256).alias("h")).alias("_p"))
    listed = one.groupBy(group).agg(F.sha2(F.array_join(F.transform(F.sort_array(F.collect_list("_p")), lambda p: p["h"]), ""), 256).alias("hash"))
    ledger = known.select(group, F.col("hash").alias("_was"))
    return listed.join(ledger, group, "left").select(group, "hash", F.when(F.col("hash") == F.col("_was"), "re-run").otherwise("new").alias("verdict"))


def tree_hash(content: DataFrame, group: str, path: str, text: str) -> DataFrame:
    """(group, n, hash): one hash over a group's contents, as a tree: over the paths of each of 4096 parts, then over the parts.

    A path's part is the first three digits of its own hash, so it hangs on the path alone; no row holds more than a part's
    hashes or 4096 of them. Null text counts as empty, a null path as the path "", and repeated rows count again.
    """
    named = content.select(group, F.coalesce(F.col(path).cast("string"), F.lit("")).alias("_path"), F.sha2(F.coalesce(F.col(text).cast("string"), F.lit("")), 256).alias("_h"))
    joined = lambda c: F.sha2(F.array_join(F.transform(F.sort_array(F.collect_list(c)), lambda x: x["h"]), ""), 256)
    parts = named.groupBy(group, F.substring(F.sha2("_path", 256), 1, 3).alias("_part")).agg(F.count(F.lit(1)).alias("_n"), joined(F.struct("_path", F.col("_h").alias("h"))).alias("_h"))
    return parts.groupBy(group).agg(F.sum("_n").alias("n"), joined(F.struct("_part", F.col("_h").alias("h"))).alias("hash"))


def harmonised(tables: dict[str, DataFrame], columns: dict[str, list[str]], constants: dict[str, dict[str, Column]] | None = None) -> DataFrame:
    """Tables under one schema: each column is the first of its names that a table has (none: null), with `model_type` naming the table."""
    out = None
    for name, rows in tables.items():
        given = (constants or {}).get(name, {})
        picked = [(given[c] if c in given else F.coalesce(*(F.col(n) for n in names if n in rows.columns), F.lit(None))).alias(c) for c, names in columns.items()]
        part = rows.select(*picked, F.lit(name).alias("model_type"))
        out = part if out is None else out.unionByName(part)
    return out


def freshness(content: DataFrame, known: DataFrame, key: str, text: str) -> DataFrame:
    """(key, hash, is_new): whether a content's SHA-256 is not in the ledger `known`."""
    hashed = content.select(key, F.sha2(F.coalesce(text, F.lit("")), 256).alias("hash"))
    ledger = known.select("hash").distinct().withColumn("_known", F.lit(True))
    return hashed.join(ledger, "hash", "left").select(key, "hash", F.col("_known").isNull().alias("is_new"))
