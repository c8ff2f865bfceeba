"""SimHash near-duplicates, found with a Gray-order hierarchical index.

Fingerprints are sorted by Gray rank, so neighbours share long bit patterns. Runs of neighbours become leaves, runs of
leaves become upper nodes; a node keeps the bits that all its members share (a mask and the masked pattern). A search
goes down level by level: a node adds the differences in the bits that it fixes and the node above doesn't, and once the
sum passes the limit all that stands below it is left out.

The index is spread over tasks by pigeonhole: fingerprints with at most `limit` differing bits agree on at least one of
limit + 1 bit blocks, so an index whose first level is (block, value) finds every link. Shards hold many such values
each. Values with many fingerprints are split again by the blocks of the other bits, which loses no link either.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import linked_groups
from .shared import LOWER, joined_words, kept, only, steps, strings, word_spans

LIMIT = 4
SHINGLE = 4
#: Fingerprints of one (block, value) from which it is split by further blocks.
SPLIT_FROM = 3000
LEAF, FAN = 16, 16
#: Entries of the index that a task holds at a time, about.
SHARD_ROWS = 300_000
#: Pairs of a query and a node that one step looks at.
PAIRS = 1 << 18


def simhash_batch(texts: pa.Array, shingle: int = SHINGLE) -> np.ndarray:
    """64-bit fingerprints (uint64) of lower-cased word shingles."""
    out = []
    for _, _, data, offsets in steps(texts):
        data = LOWER[data]
        starts, ends, first = word_spans(data, offsets)
        n_words = np.diff(first)
        joined, new_starts, new_ends = joined_words(data, starts, ends)
        n_shingles = np.where(n_words >= shingle, n_words - shingle + 1, np.minimum(n_words, 1))
        total = int(n_shingles.sum())
        begin = np.repeat(first[:-1] - np.concatenate([[0], np.cumsum(n_shingles)[:-1]]), n_shingles) + np.arange(total)
        last = np.minimum(begin + shingle, np.repeat(first[1:], n_shingles)) - 1
        raw, digest = joined.tobytes(), xxhash.xxh64_intdigest
        hashes = np.fromiter((digest(raw[s:e], 42) for s, e in zip(new_starts[begin].tolist(), new_ends[last].tolist(), strict=True)), np.uint64, total)
        out.append(majority(hashes, n_shingles))
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def majority(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """For consecutive groups of hashes: the bits set in over half of each group (empty group: 0)."""
    out = np.zeros(len(sizes), np.uint64)
    full = np.flatnonzero(sizes)
    if not len(full):
        return out
    ends = np.cumsum(sizes[full])
    begins = ends - sizes[full]
    # parts of at most 255 hashes: byte lanes of a 64-bit sum can't run over
    parts = -(-sizes[full] // 255)
    owner = np.repeat(np.arange(len(full)), parts)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(parts) - parts, parts)
    cuts = begins[owner] + 255 * nth
    heads = np.cumsum(parts) - parts
    lanes = np.uint64(0x0101010101010101)
    fp = np.zeros(len(full), np.uint64)
    for bit in range(8):
        sums = np.add.reduceat((hashes >> np.uint64(bit)) & lanes, cuts)
        for byte in range(8):
            counts = np.add.reduceat((sums >> np.uint64(8 * byte)) & np.uint64(255), heads)
            fp |= (2 * counts > sizes[full].astype(np.uint64)).astype(np.uint64) << np.uint64(8 * byte + bit)
    out[full] = fp
    return out


def with_simhash(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp): fp is the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only()
        for b in batches:
            fp = simhash_batch(strings(b.column(1)), shingle)
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int64()), pa.array(fp.view(np.int64))], ["doc_id", "fp"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, fp long")


def gray_rank(fp: np.ndarray) -> np.ndarray:
    """Place of each fingerprint in the reflected Gray code."""
    rank = fp.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class GrayIndex:
    """Fingerprints of one or more words, in buckets by key; pairs of a bucket with at most `limit` differing bits.

    With `group`, only pairs of different groups are of interest. A node also keeps its members' least and greatest
    group then, and a query leaves out a node whose members are all of its own group, whatever their number.
    """

    def __init__(self, key: np.ndarray, fp: np.ndarray, limit: int, group: np.ndarray | None = None):
        fp = fp if fp.ndim == 2 else fp[:, None]
        self.order = np.lexsort((gray_rank(fp[:, 0]), key))
        self.fp, self.limit, key = fp[self.order], limit, key[self.order]
        self.looked = 0  # pairs of a query and an entry that no node had left out
        n = len(key)
        new = np.ones(n, bool)
        new[1:] = key[1:] != key[:-1]
        bucket = np.cumsum(new) - 1
        # levels from the top: (first child, mask, pattern); a node's children stand together
        self.levels = []
        starts, mask = np.arange(n + 1), np.full(self.fp.shape, ~np.uint64(0))
        pattern, owner = self.fp, bucket
        self.group = None if group is None else group[self.order]
        ends = [] if group is None else [(self.group, self.group)]  # least and greatest group below, from the entries up
        for fan in (LEAF, FAN, n + 1):
            head = np.ones(len(owner), bool)
            head[1:] = owner[1:] != owner[:-1]
            heads = np.flatnonzero(head)
            nth = np.arange(len(owner)) - np.repeat(heads, np.diff(np.append(heads, len(owner))))
            cuts = np.flatnonzero(nth % fan == 0)
            if len(cuts):
                shared = ~(np.bitwise_and.reduceat(pattern, cuts) ^ np.bitwise_or.reduceat(pattern, cuts)) & np.bitwise_and.reduceat(mask, cuts)
                pattern, mask, owner = pattern[cuts] & shared, shared, owner[cuts]
                if ends:
                    ends.append((np.minimum.reduceat(ends[-1][0], cuts), np.maximum.reduceat(ends[-1][1], cuts)))
            self.levels.insert(0, (np.append(cuts, len(starts) - 1), mask, pattern))
            starts = np.append(cuts, n)
        self.bucket, self.ends = bucket, ends[::-1]

    def pairs(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places in the arrays that the index was made of, each pair once."""
        n = len(self.bucket)
        sizes = np.bincount(self.bucket) if n else np.zeros(0, np.int64)
        several = sizes > 1
        if self.ends and n:
            several &= self.ends[0][0] < self.ends[0][1]
        crowded = np.flatnonzero(several[self.bucket])
        at = 0
        while at < len(crowded):
            q = crowded[at : at + 4096]
            yield from self.below(q, self.bucket[q], np.zeros(len(q), np.int64), 0)
            at += 4096

    def below(self, q: np.ndarray, node: np.ndarray, differ: np.ndarray, level: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Of queries and nodes with the differences so far: what is within the limit below. An entry is paired with earlier ones."""
        first, mask, pattern = self.levels[level]
        last = level == len(self.levels) - 1
        under = (self.fp, None) if last else (self.levels[level + 1][2], self.levels[level + 1][1])
        sizes = first[node + 1] - first[node]
        at = 0
        ends = np.cumsum(sizes)
        while at < len(node):
            stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PAIRS, "right")))
            size = sizes[at:stop]
            owner = np.repeat(np.arange(at, stop), size)
            child = np.repeat(first[node[at:stop]] - np.cumsum(size) + size, size) + np.arange(len(owner))
            begin = child if last else self.entry(level + 1, child)
            ok = begin < q[owner]
            if self.ends:
                low, high = self.ends[level + 1]
                own = self.group[q[owner]]
                ok &= (low[child] != own) | (high[child] != own)
            owner, child = owner[ok], child[ok]
            fixed = ~mask[node[owner]] if under[1] is None else under[1][child] & ~mask[node[owner]]
            d = differ[owner] + np.bitwise_count((self.fp[q[owner]] ^ under[0][child]) & fixed).sum(1, dtype=np.int64)
            if last:
                self.looked += len(d)
            ok = d <= self.limit
            if last:
                yield self.order[q[owner[ok]]], self.order[child[ok]]
            elif ok.any():
                yield from self.below(q[owner[ok]], child[ok], d[ok], level + 1)
            at = stop

    def entry(self, level: int, node: np.ndarray) -> np.ndarray:
        """The first entry below each node of a level."""
        for first, _, _ in self.levels[level:]:
            node = first[node]
        return node


def joined_up(n: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The root of each of n places, where pairs of places are linked."""
    root = np.arange(n)

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in pairs:
        top = np.stack([root[a], root[b]])
        a, b = np.unique(top[:, top[0] != top[1]], axis=1)
        for u, v in zip(a.tolist(), b.tolist(), strict=True):
            u, v = find(u), find(v)
            if u != v:
                root[max(u, v)] = min(u, v)
    while (root[root] != root).any():
        root = root[root]
    return root


def split_once(rows: DataFrame, limit: int) -> DataFrame:
    """Each (key, bits, fp) under the limit + 1 keys that add one block of the bits not yet fixed.

    A level's blocks are cut from the bits that the key leaves free: block i takes every free bit whose place among
    the free ones, modulo limit + 1, is i. `bits` is the mask of fixed bits.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fixed = b.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
            fp = b.column(2).to_numpy(zero_copy_only=False).view(np.uint64)
            keys = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for mask in np.unique(fixed):
                here = fixed == mask
                free = [i for i in range(64) if not int(mask) >> i & 1]
                for i in range(limit + 1):
                    add = np.uint64(sum(1 << x for x in free[i :: limit + 1]))
                    new = keys[here] * np.uint64(0x9E3779B97F4A7C15) + (fp[here] & add) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(i + 1)
                    new ^= new >> np.uint64(29)
                    yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in (new, np.full(len(new), mask | add), fp[here])], ["key", "bits", "fp"])

    return rows.mapInArrow(run, "key long, bits long, fp long")


def fingerprint_links(fps: DataFrame, limit: int = LIMIT, split_from: int = SPLIT_FROM, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Links (a, b) between distinct fingerprints (column fp) whose closure has every pair with at most `limit` differing bits.

    A value with more than split_from fingerprints is split until none has; each split fixes a part of the free bits,
    and where no more than `limit` are free there are few fingerprints.
    """
    rows = split_once(fps.select(F.lit(0).cast("long").alias("key"), F.lit(0).cast("long").alias("bits"), "fp"), limit)
    done: list[DataFrame] = []
    while True:
        rows = kept(rows, "simhash-keys")
        large = kept(rows.groupBy("key").count().filter(F.col("count") > split_from).select("key"), "simhash-large")
        if large.isEmpty():
            break
        done.append(rows.join(large, "key", "left_anti"))
        rows = split_once(rows.join(large, "key", "left_semi"), limit)
    done.append(rows)
    every = reduce(DataFrame.unionByName, done)
    shards = max(1, every.count() // shard_rows)

    def search(part: pa.Table) -> pa.Table:
        key, fp = (part.column(c).to_numpy() for c in ("key", "fp"))
        index = GrayIndex(key, fp.view(np.uint64), limit)
        root = joined_up(len(fp), index.pairs())
        linked = np.flatnonzero(fp != fp[root])
        pairs = np.unique(np.stack([fp[linked], fp[root[linked]]]), axis=1) if len(linked) else np.zeros((2, 0), np.int64)
        return pa.table([pa.array(pairs[0]), pa.array(pairs[1])], names=["a", "b"])

    # keys are hashes of (block, value): what two of them share by chance is only compared in vain
    sharded = every.select(F.pmod(F.xxhash64("key"), F.lit(shards)).alias("shard"), "key", "fp")
    return sharded.groupBy("shard").applyInArrow(search, "a long, b long")


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT, shingle: int = SHINGLE) -> DataFrame:
    """One row for each row of docs: doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable by links).

    Null text counts as empty; texts without words have fingerprint zero and are linked like any other. Repeated rows
    give repeated result rows. A null doc_id has a row too; a component of null ids only has a null component_id.
    An empty table gives an empty result; further columns of docs are not read.
    """
    rows = kept(with_simhash(docs, id_col, text_col, shingle), "simhash")
    fps = kept(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-distinct")
    links = kept(fingerprint_links(fps.select("fp"), limit), "simhash-links")
    groups = linked_groups(links)  # node, group
    named = fps.join(groups, fps.fp == groups.node, "left").select("fp", "first_id", F.coalesce("group", "fp").alias("group"))
    named = kept(named, "simhash-groups")
    least = named.groupBy("group").agg(F.min("first_id").alias("component_id"))
    labels = kept(named.join(least, "group").select("fp", "component_id"), "simhash-labels")
    return rows.join(labels, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
