"""Groups of texts whose sets of five-word shingles have a Jaccard similarity of 0.8 or more, by wide SimHash fingerprints.

At that similarity 15 % of SimHash bits differ, too many for the blocks of 64 bits. So a fingerprint has 256 bits here, of
which about 39 differ (and with any likelihood no more than LIMIT), and tables of sampled bits stand for the blocks: a
pair of similarity 0.8 agrees on all bits of at least one table with a probability of RECALL, more alike ones with more.
A table has so many bits that few texts that aren't alike share its value, and there are as many tables as RECALL then
asks for. In each (table, value) the Gray-order index of simhash_groups finds the pairs within the limit, and every one
of them is verified by its exact similarity, so no false link is made.

Equal texts are folded first. Pairs are looked at in two passes. The first compares each text with one text of its value,
drawn by hash, and joins those that are alike. The second looks for texts of different groups only: the index leaves out
every node whose members are all of the query's group, and a pair is dropped as soon as others have joined its groups. So
a large group of different near copies costs a few comparisons for each. What remains quadratic is many texts that share a
value and lie within the limit without being alike. The entries of one value meet in one task, as numbers. Pairs to verify
are dealt into cells by the hashes of both ends, and a cell gets each text's shingles once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import linked_groups
from .shared import LOWER, Hasher, inside, kept, mixed, only, packed, steps, strings, unpacked, word_spans
from .simhash_groups import GrayIndex, majority

SHINGLE = 5
#: 64-bit words of a fingerprint.
WIDTH = 4
#: Probability that a pair of similarity 0.8 shares a table's value.
RECALL = 0.997
#: Share of bits that are equal at a similarity of 0.8: 1 - arccos(0.8 / 0.9) / pi.
EQUAL_BITS = 0.8486
#: Differing bits of 256 up to which a pair is verified.
LIMIT = 54
#: Bytes of entries in a shard, and of shingles that a cell holds of each side, about.
SHARD_BYTES, CELL_BYTES = 8 << 20, 16 << 20
#: Shares of the tables whose entries are shuffled one after the other.
PASSES = 3
WORDS = Hasher(515)
SEEDS = np.random.Generator(np.random.PCG64(82)).integers(1, 2**63, WIDTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
STEP = np.uint64(0x9E3779B97F4A7C15)


def shingle_hashes(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For runs of rows: different hashes of lower-cased word shingles, row by row in ascending order, and how many each row has.

    A text of fewer words than a shingle is one shingle.
    """
    for _, _, data, offsets in steps(texts):
        data = LOWER[data]
        starts, ends, first = word_spans(data, offsets)
        words, n_words = WORDS.spans(data, starts, ends), np.diff(first)
        at = np.flatnonzero(inside(n_words, first, SHINGLE, len(words)))
        hashes = WORDS.windows(words, SHINGLE)[at]
        for n in range(1, SHINGLE):
            few = first[:-1][n_words == n]
            at, hashes = np.concatenate([at, few]), np.concatenate([hashes, WORDS.windows(words, n)[few] if len(few) else hashes[:0]])
        owner = np.searchsorted(first, at, "right") - 1
        order = np.lexsort((hashes, owner))
        owner, hashes = owner[order], hashes[order]
        new = np.ones(len(owner), bool)
        new[1:] = (owner[1:] != owner[:-1]) | (hashes[1:] != hashes[:-1])
        yield hashes[new], np.bincount(owner[new], minlength=len(n_words))


def wide_fingerprints(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """(rows, WIDTH): a row's fingerprint; rows without shingles have zeros."""
    return np.stack([majority(mixed(hashes * seed), sizes) for seed in SEEDS], 1)


def table_masks(texts: int) -> np.ndarray:
    """(tables, WIDTH): for each table the mask of each word's bits; a value is shared by about 1000 texts at most by chance."""
    bits = max(14, int(max(texts, 1) - 1).bit_length() - 10)
    tables = int(np.ceil(np.log(1 - RECALL) / np.log1p(-(EQUAL_BITS**bits))))
    rng = np.random.Generator(np.random.PCG64(83))
    out = np.zeros((tables, WIDTH), np.uint64)
    for mask in out:
        for bit in rng.choice(64 * WIDTH, bits, replace=False).tolist():
            mask[bit // 64] |= np.uint64(1) << np.uint64(bit % 64)
    return out


def table_keys(fp: np.ndarray, masks: np.ndarray) -> np.ndarray:
    """(rows, tables): hashes of each table and its bits of a fingerprint."""
    out = np.zeros((len(fp), len(masks)), np.uint64)
    for t, mask in enumerate(masks):
        h = np.full(len(fp), np.uint64(t + 1))
        for w in range(WIDTH):
            h = mixed(h * STEP + (fp[:, w] & mask[w]))
        out[:, t] = h
    return out


def node_of(text_col: str = "text") -> Column:
    """What stands for a text; null counts as empty."""
    return F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))


def with_fingerprints(nodes: DataFrame) -> DataFrame:
    """(node, fp) of (node, text): fp is the fingerprint's words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only()
        for b in batches:
            fp = np.concatenate([np.zeros((0, WIDTH), np.uint64), *(wide_fingerprints(h, n) for h, n in shingle_hashes(strings(b.column(1))))])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([x.tobytes() for x in fp], pa.binary())], ["node", "fp"])

    return nodes.mapInArrow(run, "node long, fp binary")


def with_shingles(nodes: DataFrame) -> DataFrame:
    """(node, shingles) of (node, text): the different shingle hashes, ascending."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only()
        for b in batches:
            row = 0
            for hashes, sizes in shingle_hashes(strings(b.column(1))):
                cuts = np.concatenate([[0], np.cumsum(sizes)]).tolist()
                yield pa.RecordBatch.from_arrays([b.column(0).slice(row, len(sizes)), pa.array([packed(hashes[x:y]) for x, y in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary())], ["node", "shingles"])
                row += len(sizes)

    return nodes.mapInArrow(run, "node long, shingles binary")


def to_shards(prints: DataFrame, masks: np.ndarray, shards: int, carried: str) -> DataFrame:
    """(shard, keys, nodes, carried), packed, of (node, fp, ...): an entry for each table; carried is "fp" or another long column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only()
        for b in batches:
            for at in range(0, b.num_rows, 4096):
                part = b.slice(at, 4096)
                node = part.column(0).to_numpy(zero_copy_only=False)
                fp = unpacked(part.column(1)).reshape(-1, WIDTH)
                more = fp if carried == "fp" else part.column(2).to_numpy(zero_copy_only=False)
                key = table_keys(fp, masks).ravel()
                shard = (key % np.uint64(shards)).astype(np.int64)
                order = np.argsort(shard, kind="stable")
                row, key, shard = order // len(masks), key[order], shard[order]
                numbers, first = np.unique(shard, return_index=True)
                cuts = list(zip(first.tolist(), [*first[1:].tolist(), len(shard)], strict=True))
                columns = [pa.array([packed(x[i:j]) for i, j in cuts], pa.binary()) for x in (key, node[row], more[row])]
                yield pa.RecordBatch.from_arrays([pa.array(numbers), *columns], ["shard", "keys", "nodes", "carried"])

    columns = ["node", "fp"] if carried == "fp" else ["node", "fp", carried]
    return prints.select(*columns).mapInArrow(run, "shard long, keys binary, nodes binary, carried binary")


def entries(part: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return unpacked(part.column("keys")), unpacked(part.column("nodes"), np.int64), unpacked(part.column("carried")).reshape(-1, WIDTH)


def in_cells(a: np.ndarray, b: np.ndarray, side: int) -> pa.Table:
    """(cell, a, b), packed: pairs of nodes, each once, by the hashes of the lesser and the greater end."""
    pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)]), axis=1) if len(a) else np.zeros((2, 0), np.int64)
    cell = part_of(pairs[0], side) * side + part_of(pairs[1], side)
    order = np.argsort(cell, kind="stable")
    numbers, first = np.unique(cell[order], return_index=True)
    cuts = list(zip(first.tolist(), [*first[1:].tolist(), len(order)][: len(first)], strict=True))
    return pa.table([pa.array(numbers, pa.int64()), *(pa.array([packed(x[order[i:j]]) for i, j in cuts], pa.binary()) for x in pairs)], names=["cell", "a", "b"])


def part_of(node: np.ndarray, side: int) -> np.ndarray:
    return (mixed(node.view(np.uint64)) % np.uint64(side)).astype(np.int64)


def drawn_pairs(shards: DataFrame) -> DataFrame:
    """Pairs, in one cell, of each text and the one drawn for its (table, value), within the limit."""

    def run(part: pa.Table) -> pa.Table:
        only()
        key, node, fp = entries(part)
        order = np.lexsort((mixed(node.view(np.uint64) ^ key), key))
        head = np.ones(len(order), bool)
        head[1:] = key[order[1:]] != key[order[:-1]]
        drawn = order[np.maximum.accumulate(np.where(head, np.arange(len(order)), 0))]
        ok = (np.bitwise_count(fp[order] ^ fp[drawn]).sum(1, dtype=np.int64) <= LIMIT) & (order != drawn)
        return in_cells(node[order[ok]], node[drawn[ok]], 1)

    return shards.groupBy("shard").applyInArrow(run, "cell long, a binary, b binary")


def open_pairs(shards: DataFrame, members: DataFrame) -> DataFrame:
    """Pairs, in one cell, of texts of different groups within the limit; members are the groups so far, in the same shards."""

    def run(part: pa.Table, told: pa.Table) -> pa.Table:
        only()
        if not part.num_rows:
            return in_cells(np.zeros(0, np.int64), np.zeros(0, np.int64), 1)
        key, node, fp = entries(part)
        group = node.copy()
        member, at = np.unique(unpacked(told.column("nodes"), np.int64), return_index=True)
        if len(member):
            place = np.minimum(np.searchsorted(member, node), len(member) - 1)
            known = member[place] == node
            group[known] = unpacked(told.column("carried"), np.int64)[at][place[known]]
        a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for x, y in GrayIndex(key, fp, LIMIT, group).pairs():
            a.append(node[x])
            b.append(node[y])
        return in_cells(np.concatenate(a), np.concatenate(b), 1)

    return shards.groupBy("shard").cogroup(members.groupBy("shard")).applyInArrow(run, "cell long, a binary, b binary")


def named_nodes(packed_nodes: DataFrame, columns: list[str]) -> DataFrame:
    """(cell, node) rows of packed columns, repeats included."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for cell, *parts in zip(*(b.column(i).to_pylist() for i in range(b.num_columns)), strict=True):
                node = np.unique(np.frombuffer(b"".join(parts), np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(node), cell)), pa.array(node)], ["cell", "node"])

    return packed_nodes.select("cell", *columns).mapInArrow(run, "cell long, node long")


def verified(pairs: DataFrame, sets: DataFrame, groups: DataFrame | None) -> DataFrame:
    """Links (a, b): of the pairs in cells those whose sets have a similarity of 0.8 or more (both empty: yes).

    Pairs that the cell's own links, or the groups so far, join already are left out.
    """
    needed = named_nodes(pairs, ["a", "b"]).distinct().join(sets, "node")
    needed = needed.withColumn("group", F.col("node")) if groups is None else needed.join(groups, "node", "left").withColumn("group", F.coalesce("group", "node"))

    def run(part: pa.Table, here: pa.Table) -> pa.Table:
        only()
        a, b = unpacked(part.column("a"), np.int64), unpacked(part.column("b"), np.int64)
        a, b = np.unique(np.stack([a, b]), axis=1)
        node = here.column("node").to_numpy()
        order = np.argsort(node)
        node, group = node[order], here.column("group").to_numpy()[order]
        shingles = [np.frombuffer(x.as_py(), np.uint64) for x in here.column("shingles").take(pa.array(order)).combine_chunks()] if len(order) else []
        names, root = np.unique(group, return_inverse=True)
        top = list(range(len(names)))

        def find(x: int) -> int:
            while top[x] != x:
                top[x] = top[top[x]]
                x = top[x]
            return x

        links = []
        size = np.array([len(x) for x in shingles], np.int64)
        i, j = np.searchsorted(node, a), np.searchsorted(node, b)
        ok = 5 * np.minimum(size[i], size[j]) >= 4 * np.maximum(size[i], size[j])
        i, j = i[ok], j[ok]
        order = np.argsort(i, kind="stable")
        for x, y in zip(i[order].tolist(), j[order].tolist(), strict=True):
            u, v = find(int(root[x])), find(int(root[y]))
            if u != v:
                p, q = shingles[x], shingles[y]
                both = len(np.intersect1d(p, q, assume_unique=True))
                if 5 * both >= 4 * (len(p) + len(q) - both):
                    top[max(u, v)] = min(u, v)
                    links.append((int(node[x]), int(node[y])))
        columns = list(zip(*links, strict=True)) or [[], []]
        return pa.table([pa.array(c, pa.int64()) for c in columns], names=["a", "b"])

    return pairs.groupBy("cell").cogroup(needed.select("cell", "node", "shingles", "group").groupBy("cell")).applyInArrow(run, "a long, b long")


def near_copy_groups(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(node, group) of texts that have near copies; group is the smallest node reachable by links of similarity 0.8 or more.

    A node is node_of(text). Texts without words are alike; a text of fewer than five words is one shingle. Texts that
    are like no other have no row; repeated rows are one text; further columns are not read.
    """
    nodes = docs.select(node_of(text_col).alias("node"), F.col(text_col).alias("text"))
    prints = kept(with_fingerprints(nodes).groupBy("node").agg(F.first("fp").alias("fp")), "near-prints")
    count = prints.count()
    masks = table_masks(count)
    drawn = in_passes(masks, count, lambda part, shards: drawn_pairs(to_shards(prints, part, shards, "fp")), "near-drawn")
    sets = kept(shingle_sets(nodes, named_nodes(drawn, ["a", "b"])), "near-shingles")
    first = kept(verified(coarser(drawn, sides(sets)), sets, None), "near-links")
    groups = linked_groups(first)
    members = kept(prints.join(groups.filter("node <> group"), "node"), "near-members")
    rest = in_passes(masks, count, lambda part, shards: open_pairs(to_shards(prints, part, shards, "fp"), to_shards(members, part, shards, "group")), "near-open")
    new = named_nodes(rest, ["a", "b"]).join(sets, "node", "left_anti")
    sets = sets.unionByName(kept(shingle_sets(nodes, new), "near-shingles"))
    links = first.unionByName(kept(verified(coarser(rest, sides(sets)), sets, groups), "near-links"))
    return linked_groups(links)


def in_passes(masks: np.ndarray, texts: int, found: Callable[[np.ndarray, int], DataFrame], name: str) -> DataFrame:
    """What is found of some tables' entries in so many shards, for a share of the tables after the other.

    An entry bears a fingerprint, so entries are many times as large as the fingerprints: they are made anew for each job,
    not kept, and disk holds those of one share at a time.
    """
    out = []
    for part in np.array_split(masks, min(PASSES, len(masks))):
        shards = max(1, texts * len(part) * (16 + 8 * WIDTH) // SHARD_BYTES)
        out.append(kept(found(part, shards), name))
    return reduce(DataFrame.unionByName, out)


def shingle_sets(nodes: DataFrame, named: DataFrame) -> DataFrame:
    """(node, shingles) of the named nodes; grouped by what they are joined by, so that texts are shuffled once and sets aren't."""
    found = nodes.join(named.select("node").distinct(), "node", "left_semi")
    return with_shingles(found.groupBy("node").agg(F.first("text").alias("text")))


def sides(sets: DataFrame) -> int:
    """Sides of the cells: as many as the shingles of texts with a pair ask for."""
    held = sets.agg(F.sum(F.octet_length("shingles"))).first()[0] or 0
    return max(1, -(-held // CELL_BYTES))


def coarser(pairs: DataFrame, side: int) -> DataFrame:
    """Pairs in the cells of another side."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield from in_cells(unpacked(b.column(1), np.int64), unpacked(b.column(2), np.int64), side).to_batches()

    return pairs.mapInArrow(run, "cell long, a binary, b binary")
