"""Document fingerprints by a randomised edit embedding.

All texts walk with the same random bits: at step j the walk writes its character down and goes on to the next one if
bit j of that character says so. After an insertion, deletion or change two walks soon meet again at equal characters
and stay together, so edit distance between texts becomes Hamming distance between what they write. The fingerprint
samples the written characters at shared random steps, as many in each doubling of the steps, so that near the start
and far into very long texts alike there are samples.

Near texts are found by bands. Of each of a text's last octaves, which hold most of its steps, BANDS bands of randomly
sampled bits (PICKED samples of four bits each) are its keys; a text of fewer samples than an octave has keys by
pigeonhole over all of them, so very short texts share a key only if they are nearly alike. Equal fingerprints are folded first. Each text is compared
with one other of its band, drawn by hash, and joined to it if the share of equal samples, weighted by the steps that
each stands for, is LEAST or more. Then, in bands that still hold several groups, texts of different groups are compared.
So a large group of near copies costs a few comparisons for each text, and none of a band's pairs is left out.
"""

from __future__ import annotations

import bisect
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import linked_groups
from .shared import kept, mixed, only

SAMPLES = 32
FIRST = 6  # steps before 2**FIRST are one octave
#: Octaves whose bands are keys, bands of each and samples of a band; likeness from which texts are near.
LAST, BANDS, PICKED, LEAST = 2, 12, 10, 0.8
#: Rows of open bands in a shard, about.
SHARD_ROWS = 20_000
#: Rows of a band up to which its pairs are looked at together with other bands'.
FEW_ROWS = 100
MULTIPLIER = 0x9E3779B1
PERIOD = 1 << 16
NONE = 255
#: Walks that are carried on one by one when no more than so many are left.
FEW = 20
STEP_CHARS = 6_000_000
_rng = np.random.Generator(np.random.PCG64(310))
BITS = _rng.integers(0, 2**32, PERIOD, dtype=np.uint32)
_BITS = BITS.tolist()
HEX = np.frombuffer(b"0123456789abcdef", np.uint8)
FROM_HEX = np.full(256, NONE, np.uint8)
FROM_HEX[HEX] = np.arange(16)
MANY = np.uint64(0x9E3779B97F4A7C15)
PICKS = np.stack([_rng.choice(SAMPLES, PICKED, replace=False) for _ in range(BANDS)])


def sampled_steps(octaves: int) -> np.ndarray:
    """Steps at which samples are taken, ascending; the same for all texts."""
    rng = np.random.Generator(np.random.PCG64(77))
    out = [np.sort(rng.choice(1 << FIRST, SAMPLES, replace=False))]
    for k in range(FIRST, FIRST + octaves - 1):
        out.append(np.sort((1 << k) + rng.choice(1 << k, SAMPLES, replace=False)))
    return np.concatenate(out)


def sample_weights(n: int) -> np.ndarray:
    octave = np.arange(n) // SAMPLES
    return np.where(octave == 0, 1 << FIRST, 2.0 ** (FIRST - 1 + octave)) / SAMPLES


def embedded(texts: list[str]) -> np.ndarray:
    """Samples (0 to 15, NONE after the walk's end) of each text, (texts, samples)."""
    lengths = np.array([len(t) for t in texts], np.int64)
    octaves = max(1, int(3 * lengths.max(initial=1) - 1).bit_length() - FIRST + 1)
    steps = sampled_steps(octaves)
    out = np.full((len(texts), len(steps)), NONE, np.uint8)
    if not lengths.any():
        return out
    pad = np.zeros(65, np.uint32).tobytes()
    codes = np.frombuffer(b"".join(x for t in texts for x in (t.encode("utf-32-le"), pad)), np.uint32)
    starts = np.concatenate([[0], np.cumsum(lengths + 65)[:-1]])
    ends = starts + lengths
    hashed = (codes + np.uint32(1)) * np.uint32(0x85EBCA77)
    hashed ^= hashed >> np.uint32(13)
    nibble = ((hashed * np.uint32(0xC2B2AE3D)) >> np.uint32(28)).astype(np.uint8)
    at = np.concatenate([np.arange(e, e + 65) for e in ends])
    nibble[at] = NONE
    active = np.flatnonzero(lengths)
    pos = starts[active]
    j, s = 0, 0
    multiplier, shift = np.uint32(MULTIPLIER), np.uint32(31)
    while len(active) > FEW:
        v = np.empty(len(active), np.uint32)
        for k in range(j, j + 64):
            if s < len(steps) and steps[s] == k:
                out[active, s] = nibble[pos]
                s += 1
            np.take(hashed, pos, out=v)
            np.bitwise_xor(v, BITS[k % PERIOD], out=v)
            np.multiply(v, multiplier, out=v)
            np.right_shift(v, shift, out=v)
            np.add(pos, v, out=pos)
        j += 64
        on = pos < ends[active]
        active, pos = active[on], pos[on]
    for i, p in zip(active.tolist(), pos.tolist(), strict=True):  # the longest few
        end, row, k, at = int(ends[i]), out[i], j, s
        text = hashed[p:end].tolist()
        n, p0, q = len(text), p, 0
        while q < n:
            stop = int(steps[at]) if at < len(steps) else 1 << 62
            while k < stop and q < n:
                q += ((text[q] ^ _BITS[k % PERIOD]) * MULTIPLIER >> 31) & 1
                k += 1
            if q < n:
                row[at] = nibble[p0 + q]
                at += 1
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For rows of samples: the weighted share that are equal, of those that either has (none: 1)."""
    weights = sample_weights(a.shape[1])
    there = ((a != NONE) | (b != NONE)) @ weights
    same = ((a == b) & (a != NONE)) @ weights
    return np.where(there > 0, same / np.maximum(there, 1e-9), 1.0)


def band_keys(samples: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of the bands of each row's last whole octaves, and of the whole fingerprint where it has few samples.

    A row whose first octave isn't full has keys by pigeonhole: of u samples at most (1 - LEAST) * u differ between near
    rows, where u is the longer row's number, so that they agree on all of at least one of that many and one more blocks.
    No link between such rows is lost, and a block holds four or more samples, missing ones only where the other row is
    longer. Rows that may be near one with a full octave have that octave's bands as well.
    """
    n, width = samples.shape
    padded = np.full((n, -(-max(1, width) // SAMPLES) * SAMPLES), NONE, np.uint8)
    padded[:, :width] = samples
    there = (samples != NONE).sum(1)
    top = np.maximum(there // SAMPLES - 1, 0)
    rows, keys = [], []

    def add(row: np.ndarray, value: np.ndarray, name: np.ndarray | int) -> None:
        rows.append(row)
        keys.append(mixed(value ^ mixed(np.atleast_1d(np.asarray(name, np.uint64)) * MANY)))

    for back in range(LAST):
        row = np.flatnonzero((top >= back) & (there >= LEAST * SAMPLES))
        octave = top[row] - back
        for band, pick in enumerate(PICKS):
            value = np.zeros(len(row), np.uint64)
            for i in pick:
                value = value * MANY + padded[row, octave * SAMPLES + i]
            add(row, value, octave * BANDS + band + 1)
    for u in range(1, SAMPLES):
        row = np.flatnonzero((there <= u) & (there >= LEAST * u - 1e-9))
        blocks = int((1 - LEAST) * u + 1e-9) + 1
        for block in range(blocks if len(row) else 0):
            value = np.zeros(len(row), np.uint64)
            for i in range(block, u, blocks):
                value = value * MANY + padded[row, i]
            add(row, value, (1 << 32) + u * SAMPLES + block)
    return np.concatenate([np.zeros(0, np.int64), *rows]), np.concatenate([np.zeros(0, np.uint64), *keys])


def banded(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether rows share a band's key, and so are candidates."""
    out = np.zeros(len(a), bool)
    (i, x), (j, y) = band_keys(a), band_keys(b)
    shared = np.intersect1d(mixed(x + i.astype(np.uint64)), mixed(y + j.astype(np.uint64)))
    out[i[np.isin(mixed(x + i.astype(np.uint64)), shared)]] = True
    return out


def unwritten(fingerprints: list[str]) -> np.ndarray:
    """Samples of fingerprints in hex digits, NONE behind the end."""
    sizes = np.array([len(f) for f in fingerprints], np.int64)
    out = np.full((len(sizes), int(sizes.max(initial=0))), NONE, np.uint8)
    out[np.arange(out.shape[1]) < sizes[:, None]] = FROM_HEX[np.frombuffer("".join(fingerprints).encode(), np.uint8)]
    return out


def written(samples: np.ndarray) -> list[str]:
    """Samples as hex digits, up to the walk's end."""
    counts = (samples != NONE).sum(1)
    digits = HEX[samples & 15]
    return [digits[i, :n].tobytes().decode() for i, n in enumerate(counts.tolist())]


def near_groups(prints: DataFrame, least: float = LEAST) -> DataFrame:
    """(node, group) of the fingerprints (node, fingerprint) that are near another; group is the smallest node reachable.

    A node is a fingerprint's hash: repeated rows are one. A fingerprint that is near no other has no row; null ones
    count as empty, and an empty table gives an empty result.
    """

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only()
        for b in batches:
            for at in range(0, b.num_rows, 2000):
                part = b.slice(at, 2000)
                row, key = band_keys(unwritten([x or "" for x in part.column(1).to_pylist()]))
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(row)), pa.array(key.view(np.int64))], ["node", "key"])

    def alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only()
        for b in batches:
            for at in range(0, b.num_rows, 2000):
                part = b.slice(at, 2000)
                n = part.num_rows
                both = unwritten(part.column(2).to_pylist() + part.column(3).to_pylist())
                ok = pa.array(likeness(both[:n], both[n:]) >= least)
                yield pa.RecordBatch.from_arrays([part.column(i).filter(ok) for i in (0, 1)], ["a", "b"])

    def search(part: pa.Table) -> pa.Table:
        """Links between groups that share a band."""
        part = part.sort_by("key")
        key, node, group = (part.column(c).to_numpy() for c in ("key", "node", "group"))
        samples = unwritten(part.column("fingerprint").to_pylist())
        names, root = np.unique(group, return_inverse=True)
        top = np.arange(len(names))
        links = []
        heads = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        sizes = np.diff(np.append(heads, len(key)))
        few = np.repeat(sizes <= FEW_ROWS, sizes)

        def near(i: np.ndarray, j: np.ndarray) -> np.ndarray:
            cuts = range(0, len(i), 4096)
            return np.concatenate([np.zeros(0, bool), *(likeness(samples[i[c : c + 4096]], samples[j[c : c + 4096]]) >= least for c in cuts)])

        def join(i: int, j: int) -> None:
            if top[root[i]] != top[root[j]]:
                links.append((int(node[i]), int(node[j])))
                top[top == top[root[j]]] = top[root[i]]

        for apart in range(1, int(sizes[sizes <= FEW_ROWS].max(initial=1))):  # small bands: all pairs at once
            i = np.flatnonzero((key[apart:] == key[:-apart]) & few[apart:] & (top[root[apart:]] != top[root[:-apart]]))
            i = i[near(i, i + apart)]
            for x in i.tolist():
                join(x, x + apart)
        for first, size in zip(heads[sizes > FEW_ROWS].tolist(), sizes[sizes > FEW_ROWS].tolist(), strict=True):
            for i in range(first + 1, first + size):
                j = first + np.flatnonzero(top[root[first:i]] != top[root[i]])
                for x in j[near(np.full(len(j), i), j)].tolist():
                    join(i, x)
        columns = list(zip(*links, strict=True)) or [[], []]
        return pa.table([pa.array(c, pa.int64()) for c in columns], names=["a", "b"])

    prints = kept(prints.groupBy("node").agg(F.first("fingerprint").alias("fingerprint")), "edit-prints")
    rows = kept(prints.select("node", "fingerprint").mapInArrow(keys, "node long, key long"), "edit-keys")
    drawn = F.min_by("node", F.xxhash64("node", "key")).alias("other")
    leaders = rows.groupBy("key").agg(drawn, F.count(F.lit(1)).alias("n")).filter("n > 1").select("key", "other")
    rows = kept(rows.join(leaders, "key"), "edit-bands")
    pairs = rows.filter("node <> other").select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct()
    a, b = (prints.select(F.col("node").alias(x), F.col("fingerprint").alias(f"f{x}")) for x in "ab")
    links = kept(pairs.join(a, "a").join(b, "b").select("a", "b", "fa", "fb").mapInArrow(alike, "a long, b long"), "edit-links")
    groups = linked_groups(links)
    placed = rows.join(groups, "node", "left").select("key", "node", F.coalesce("group", "node").alias("group"))
    several = placed.groupBy("key").agg(F.min("group").alias("low"), F.max("group").alias("high")).filter("low < high").select("key")
    still = kept(placed.join(several, "key", "left_semi").join(prints, "node"), "edit-open")
    shards = max(1, still.count() // SHARD_ROWS)
    more = still.withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(shards))).groupBy("shard").applyInArrow(search, "a long, b long")
    return linked_groups(links.unionByName(kept(more, "edit-links")))


PART_BYTES = 12 << 20
#: Parts at most (beyond that they grow; a task goes through its part row by row), and places drawn for the borders of each.
PARTS, DRAWN = 16384, 24


def with_next(docs: DataFrame, part_bytes: int = PART_BYTES) -> DataFrame:
    """(part, halo, doc_id, text, second): parts of consecutive ids in descending order, each closed by a copy of the next part's first row.

    Borders of the parts are drawn from the ids with the texts' hashes as a second key, so that ids that lie close
    together, or are equal or null, are split as well. The last part is closed by the first row of all. Null ids come
    last; equal ids are ordered by the text's hash, then by the text.
    """
    spark = docs.sparkSession
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("second", F.xxhash64("text"))
    place = [F.col("doc_id").isNull(), F.coalesce(F.bitwise_not("doc_id"), F.lit(0)), F.col("second")]
    n, size = rows.agg(F.count(F.lit(1)), F.sum(F.octet_length("text"))).first()
    parts = min(PARTS, max(1, -(-(size or 0) // part_bytes)))
    borders: list[tuple[bool, int, int]] = []
    if parts > 1:
        some = rows.select(*place).filter(F.pmod(F.xxhash64("doc_id", "second"), F.lit(max(1, n // (parts * DRAWN)))) == 0)
        drawn = sorted(map(tuple, some.collect()))  # about DRAWN for each part
        borders = sorted({drawn[i * len(drawn) // parts] for i in range(1, parts)}) if drawn else []
    shared = spark.sparkContext.broadcast(borders)

    @F.pandas_udf("int")
    def number(null: pd.Series, turned: pd.Series, second: pd.Series) -> pd.Series:
        return pd.Series([bisect.bisect_right(shared.value, x) for x in zip(null.tolist(), turned.tolist(), second.tolist(), strict=True)], dtype="int32")

    numbered = rows.select((number(*place) if borders else F.lit(0)).alias("part"), "doc_id", "text", "second")
    order = F.struct(*place, "text")
    heads = numbered.groupBy("part").agg(F.min(order).alias("o"), F.min_by("doc_id", order).alias("doc_id"))
    heads = kept(heads.select("part", "doc_id", F.col("o.second").alias("second"), F.col("o.text").alias("text")), "edit-heads")
    there = sorted(r["part"] for r in heads.select("part").collect())  # a row for each part
    before = {p: there[i - 1] for i, p in enumerate(there)}
    closes = spark.createDataFrame(sorted(before.items()), "part int, before int")
    halo = heads.join(closes, "part").select(F.col("before").alias("part"), F.lit(True).alias("halo"), "doc_id", "text", "second")
    return numbered.select("part", F.lit(False).alias("halo"), "doc_id", "text", "second").unionByName(halo)


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_bytes: int = PART_BYTES) -> DataFrame:
    """One row for each text: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, edited_banded, next_banded.

    The edited text has the last half of its code points replaced by as many of the next document's first ones (or all,
    where that is shorter), in descending order of doc_id; after the last comes the first. near_* are likenesses of
    fingerprints, *_banded tells whether the pair shares a band's key. Null text counts as empty; an
    only document is its own next one; null ids come last; an empty table gives an empty result.
    """
    rows = with_next(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), part_bytes)
    rows = rows.repartition("part").sortWithinPartitions("part", "halo", F.desc_nulls_last("doc_id"), "second", "text")
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "edited_banded", "next_banded"]

    def done(ids: list, texts: list[str], following: list[str]) -> pa.RecordBatch:
        edited = [t[: len(t) - len(t) // 2] + n[: len(t) // 2] for t, n in zip(texts, following, strict=True)]
        chain = texts + following[-1:]
        same = embedded(chain + edited)
        own, other, new = same[: len(texts)], same[1 : len(chain)], same[len(chain) :]
        columns = [pa.array(ids, pa.int64()), pa.array([len(t) for t in texts], pa.int64()), pa.array([hashlib.sha256(e.encode()).hexdigest() for e in edited], pa.string())]
        columns += [pa.array(written(own), pa.string()), pa.array(written(new), pa.string())]
        columns += [pa.array(f(own, x)) for f in (likeness, banded) for x in (new, other)]
        return pa.RecordBatch.from_arrays(columns, names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only()
        ids: list = []
        texts: list[str] = []
        chars = 0
        for b in batches:
            for halo, doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
                text = text.as_py()
                if texts and (halo or chars > STEP_CHARS):
                    yield done(ids, texts, [*texts[1:], text])
                    ids, texts, chars = [], [], 0
                if not halo:
                    ids.append(doc_id)
                    texts.append(text)
                    chars += len(text)
        assert not texts

    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, edited_banded boolean, next_banded boolean"
    return rows.select("halo", "doc_id", "text").mapInArrow(run, schema)


def grouped_fingerprints(docs: DataFrame, least: float = LEAST) -> DataFrame:
    """fingerprint_documents with group_id: the smallest doc_id of the texts reachable by links of likeness `least` or more, itself included.

    A group of null ids only has a null group_id.
    """
    node = F.xxhash64("fingerprint")
    rows = kept(fingerprint_documents(docs), "edit-documents")
    groups = near_groups(rows.select(node.alias("node"), "fingerprint"), least)
    ids = rows.groupBy(node.alias("node")).agg(F.min("doc_id").alias("first"))
    placed = ids.join(groups, "node", "left").withColumn("group", F.coalesce("group", "node"))
    smallest = placed.groupBy("group").agg(F.min("first").alias("group_id"))
    named = kept(placed.join(smallest, "group").select("node", "group_id"), "edit-groups")
    return rows.withColumn("node", node).join(named, "node").drop("node")
