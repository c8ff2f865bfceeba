"""What the operators of this subpackage share: tables, kept tables, and text as byte arrays."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Text bytes that one numpy step handles; a longer document is a step of its own.
STEP_BYTES = 1 << 20


#: Row groups of kept tables: what a task that writes one holds in memory.
ROW_GROUP_BYTES = 16 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or in local mode one of our own where that is unset (tests)."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found


def kept(df: DataFrame, name: str) -> DataFrame:
    """Writes df to the shared folder and reads it back: later jobs start from files that outlive executors.

    Shuffle files of the writing job are removed when it ends, so disk holds one job's shuffles at a time.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/kept/{name}-{uuid.uuid4().hex}"
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(setting, "false")
    spark.conf.set(setting, "true")
    try:
        df.write.option("compression", "zstd").option("parquet.block.size", ROW_GROUP_BYTES).parquet(path)
    finally:
        spark.conf.set(setting, before)
    return spark.read.schema(df.schema).parquet(path)


def let_go(df: DataFrame) -> None:
    """Deletes a kept table that no later job reads, so that the shared folder holds only what is still of use."""
    files = df.inputFiles()
    if files:
        spark = df.sparkSession
        folder = spark._jvm.org.apache.hadoop.fs.Path(files[0].rsplit("/", 1)[0])
        folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)


def spare(taken: list[str], name: str) -> str:
    """A column name like `name` that none of the taken ones clashes with."""
    low = {c.lower() for c in taken}
    while (name := f"_{name}").lower() in low:
        pass
    return name


def strings(column: pa.ChunkedArray | pa.Array) -> pa.Array:
    """One large_string array without nulls (null: empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    return pc.fill_null(column.cast(pa.large_string()), "")


def steps(column: pa.Array, limit: int = STEP_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Row ranges of a large_string array with about `limit` bytes each: (first row, end row, bytes, offsets)."""
    n = len(column)
    if not n:
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        end = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        end = min(n, max(first + 1, end))
        yield first, end, data[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first]
        first = end


#: What Python workers hold from task to task, by operator: how to let go of it.
HELD: dict[str, Callable[[], None]] = {}


def only(name: str = "") -> None:
    """Called at a task's start: lets go of what other operators' tasks have left in this worker, and gives free memory back."""
    for other, clear in HELD.items():
        if other != name:
            clear()
    pa.default_memory_pool().release_unused()
    if TRIM is not None:
        TRIM(0)


#: The C library's call that returns free memory to the system, where there is one.
TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
WHITE = np.zeros(256, bool)
WHITE[[0x20, 9, 10, 11, 12, 13]] = True


def word_spans(data: np.ndarray, offsets: np.ndarray, separator: np.ndarray = WHITE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of maximal runs without separator bytes, and each row's first word (one more entry than rows)."""
    word = ~separator[data]
    start = word.copy()
    start[1:] &= ~word[:-1]
    end = word.copy()
    end[:-1] &= ~word[1:]
    edge = offsets[1:-1]
    edge = edge[(edge > 0) & (edge < len(data))]
    start[edge] = word[edge]
    end[edge - 1] = word[edge - 1]
    starts = np.flatnonzero(start)
    return starts, np.flatnonzero(end) + 1, np.searchsorted(starts, offsets)


class Hasher:
    """64-bit hashes of byte spans and of word windows, by prefix sums of a polynomial with random byte values."""

    BASE = 0x5851F42D4C957F2D
    #: Powers of the base and of its inverse, shared by all hashers of a process.
    powers = inverses = np.ones(1, np.uint64)

    def __init__(self, seed: int):
        rng = np.random.Generator(np.random.PCG64(seed))
        self.values = rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    @classmethod
    def grow(cls, n: int) -> None:
        if n > len(Hasher.powers):
            n = max(n, 1 << 16)
            with np.errstate(over="ignore"):
                Hasher.powers, Hasher.inverses = (np.cumprod(np.concatenate([[np.uint64(1)], np.full(n - 1, x, np.uint64)])) for x in (cls.BASE, pow(cls.BASE, -1, 2**64)))

    def prefix(self, values: np.ndarray) -> np.ndarray:
        self.grow(len(values) + 1)
        out = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * self.powers[: len(values)], out=out[1:])
        return out

    def spans(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        sums = self.prefix(self.values[data])
        return mixed((sums[ends] - sums[starts]) * self.inverses[starts] + (ends - starts).astype(np.uint64))

    def windows(self, words: np.ndarray, length: int) -> np.ndarray:
        """Of every `length` consecutive words, rows not regarded (shorter input: none)."""
        n = len(words) - length + 1
        if n <= 0:
            return np.zeros(0, np.uint64)
        sums = self.prefix(words)
        return mixed((sums[length:] - sums[:n]) * self.inverses[:n] + np.uint64(length))


def mixed(h: np.ndarray) -> np.ndarray:
    """Bit mixing, so that any bits of a hash serve as well as others."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def inside(n_words: np.ndarray, first: np.ndarray, length: int, total: int) -> np.ndarray:
    """Whether the window of `length` words at each word lies within one row; one entry for each window position."""
    ok = np.zeros(max(0, total - length + 1), bool)
    if len(ok):
        last = first[1:] - length + 1
        change = np.zeros(total + 2, np.int32)
        good = last > first[:-1]
        np.add.at(change, first[:-1][good], 1)
        np.add.at(change, last[good], -1)
        ok[:] = np.cumsum(change)[: len(ok)] > 0
    return ok


def text_weight(df: DataFrame, column: str = "text") -> tuple[int, int]:
    """Rows and text bytes."""
    row = df.agg(F.count(F.lit(1)), F.sum(F.octet_length(column))).first()
    return row[0], row[1] or 0


def joined_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The given words, in order, each followed by one space: (bytes, starts, ends)."""
    new_ends = np.cumsum(ends - starts + 1) - 1
    new_starts = new_ends - (ends - starts)
    out = np.full(int(new_ends[-1]) + 1 if len(new_ends) else 0, 0x20, np.uint8)
    out[covered(len(out), new_starts, new_ends)] = data[covered(len(data), starts, ends)]
    return out, new_starts, new_ends


def covered(n: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which of n places lie in one of the ranges, which don't overlap."""
    change = np.zeros(n + 1, np.int8)
    change[starts] += 1
    change[ends] -= 1
    return np.cumsum(change[:-1], dtype=np.int8).astype(bool)


def in_blocks(docs: DataFrame, columns: list[str], block_bytes: int) -> tuple[DataFrame, int, int]:
    """docs with a column `block` of about block_bytes text bytes each, the number of blocks and of text bytes.

    The block hangs on doc_id and text alone, so each pass over the table forms the same blocks. Rows that share both
    are counted first and then dealt out one by one, so that they aren't all in one block.
    """
    _, size = text_weight(docs)
    blocks = max(1, -(-size // block_bytes))
    key = F.xxhash64("doc_id", "text")
    repeats = kept(docs.groupBy(key.alias("key")).count().filter("count > 1").select("key"), "repeats")
    if repeats.isEmpty():
        return docs.select(*columns, F.pmod(key, F.lit(blocks)).alias("block")), blocks, size
    named, nth, n = spare(columns, "key"), spare(columns, "nth"), spare(columns, "n")
    rows, repeats = docs.select(*columns, key.alias(named)), repeats.select(F.col("key").alias(named))
    once = rows.join(repeats, named, "left_anti").withColumn(nth, F.lit(0))
    more = rows.join(repeats, named, "left_semi").groupBy(*columns, named).agg(F.count(F.lit(1)).cast("int").alias(n))
    more = more.withColumn(nth, F.explode(F.sequence(F.lit(1), F.col(n)))).select(*columns, named, nth)
    return once.unionByName(more).select(*columns, F.pmod(F.xxhash64(named, nth), F.lit(blocks)).alias("block")), blocks, size


def sorted_in(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which values are in a sorted array."""
    if not len(known):
        return np.zeros(len(values), bool)
    at = np.searchsorted(known, values)
    at[at == len(known)] = 0
    return known[at] == values


def packed(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values).tobytes()


def unpacked(column: pa.ChunkedArray | pa.Array, dtype: type = np.uint64) -> np.ndarray:
    """All values of a column of packed arrays, in row order."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype)


def by_shard(hashes: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of hashes by shard and, for each shard present, its number and first place (one more entry than shards)."""
    shard = (hashes % np.uint64(shards)).astype(np.int64)
    order = np.argsort(shard, kind="stable")
    numbers, first = np.unique(shard[order], return_index=True)
    return order, numbers, np.append(first, len(hashes))
