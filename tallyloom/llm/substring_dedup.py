"""Removal of word passages that occur more than once, by level-wise doubling.

A window of `length` words is repeated only if its parts are. So short windows are counted first, and only where they
repeat are windows of twice the length looked at, up to the wanted length:

1. windows of a quarter of the length. Of all of them in a long window, the one with the least hash stands for it: two
   equal long windows choose equal short ones, so nothing is lost, and a small share of all windows travels.
2. windows of half the length, at both ends of the long windows that step 1 left.
3. the long windows that step 2 left, with 128-bit hashes.

Documents form blocks of a few MB. A block sends each different hash once to the hash's shard, and a shard sends back
those that occur again in this block or another. So a passage in very many documents costs one hash for each block.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import Hasher, by_shard, in_blocks, inside, joined_words, kept, only, packed, sorted_in, spare, steps, strings, unpacked, word_spans

LENGTH = 35
BLOCK_BYTES = 8 << 20
#: Text bytes for each shard of hashes.
SHARD_BYTES = 2 << 20
A, B = Hasher(20261), Hasher(77003)


def sliding(best: np.ufunc, x: np.ndarray, width: int) -> np.ndarray:
    """Least or most of every `width` consecutive values."""
    out, have = x, 1
    while have < width:
        step = min(have, width - have)
        out = best(out[: len(out) - step], out[step:])
        have += step
    return out


class Passages:
    """Words of some rows of a block, and hashes of their windows."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, length: int):
        self.data, self.length = data, length
        self.starts, self.ends, self.first = word_spans(data, offsets)
        self.words = A.spans(data, self.starts, self.ends)
        self.valid = inside(np.diff(self.first), self.first, length, len(self.starts))
        self.short, self.half = -(-length // 4), -(-length // 2)

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of short windows, and the least of them for each long window."""
        short = A.windows(self.words, self.short)
        return short, sliding(np.minimum, short, self.length - self.short + 1)[: len(self.valid)]

    def chosen(self) -> np.ndarray:
        """One hash for each place at which a short window stands for some long one."""
        if not self.valid.any():
            return np.zeros(0, np.uint64)
        short, least = self.anchors()
        pad = np.zeros(self.length - self.short, np.uint64)
        most = sliding(np.maximum, np.concatenate([pad, np.where(self.valid, least, np.uint64(0)), pad]), self.length - self.short + 1)
        return short[short == most]  # it is the least of one of the windows around it

    def candidates(self, repeated: np.ndarray) -> np.ndarray:
        if not self.valid.any():
            return np.zeros(0, np.int64)
        return np.flatnonzero(self.valid & sorted_in(self.anchors()[1], repeated))

    def halves(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        half = A.windows(self.words, self.half)
        return half, at, at + self.length - self.half

    def whole(self, at: np.ndarray | None = None) -> np.ndarray:
        """128-bit hashes, as pairs."""
        a, b = A.windows(self.words, self.length), B.windows(B.spans(self.data, self.starts, self.ends), self.length)
        return np.stack([a, b], 1) if at is None else np.stack([a[at], b[at]], 1)


def counted(pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different 128-bit hashes, sorted by their first half, and whether each occurs more than once."""
    if not len(pairs):
        return pairs, np.zeros(0, bool)
    pairs = pairs[np.lexsort(pairs.T[::-1])]
    new = np.ones(len(pairs), bool)
    new[1:] = (pairs[1:] != pairs[:-1]).any(1)
    heads = np.flatnonzero(new)
    return pairs[heads], np.diff(np.append(heads, len(pairs))) > 1


def repeated(sent: DataFrame, wide: bool) -> DataFrame:
    """From (block, shard, hashes, again): for each block and shard the hashes that occur elsewhere or again."""
    width = 2 if wide else 1

    def run(part: pa.Table) -> pa.Table:
        blocks = part.column("block").to_pylist()
        rows = [np.frombuffer(x, np.uint64).reshape(-1, width) for x in part.column("hashes").to_pylist()]
        again = [np.frombuffer(x, bool) for x in part.column("again").to_pylist()]
        allof = np.concatenate(rows)
        order = np.lexsort(allof.T[::-1])
        same = np.zeros(len(allof), bool)
        equal = (allof[order[1:]] == allof[order[:-1]]).all(1)
        same[order[1:][equal]] = True
        same[order[:-1][equal]] = True
        same |= np.concatenate(again)
        cuts = np.cumsum([len(x) for x in rows])[:-1]
        out = [packed(r[s]) for r, s in zip(rows, np.split(same, cuts), strict=True)]
        keep = [i for i, x in enumerate(out) if x]
        return pa.table([pa.array([blocks[i] for i in keep], pa.int64()), pa.array([out[i] for i in keep], pa.binary())], names=["block", "hashes"])

    return sent.groupBy("shard").applyInArrow(run, "block long, hashes binary")


def to_shards(block: int, pairs: np.ndarray, shards: int) -> pa.Table:
    """A block's different hashes, split by shard."""
    distinct, again = counted(pairs)
    order, numbers, first = by_shard(distinct[:, 0] if len(distinct) else np.zeros(0, np.uint64), shards)
    distinct, again = distinct[order], again[order]
    cuts = list(zip(first[:-1], first[1:], strict=True))
    return pa.table(
        [pa.array([block] * len(cuts), pa.int64()), pa.array(numbers, pa.int64()), pa.array([packed(distinct[a:b]) for a, b in cuts], pa.binary()), pa.array([packed(again[a:b]) for a, b in cuts], pa.binary())],
        names=["block", "shard", "hashes", "again"],
    )


def remove_repeats(docs: DataFrame, carry: list[str] | None = None, length: int = LENGTH, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """docs without the words that lie in a window of `length` words whose word sequence starts anywhere else as well.

    Returns the columns of `carry` (doc_id by default), n_words, n_removed and kept_text: the other words, joined by one
    space. Words are runs without ASCII white space. All windows are judged on the input. Null and empty texts have no
    words; a row that is repeated counts as another document, so its windows are repeated; null doc_ids are rows like
    others; an empty table gives an empty result. Columns outside `carry` are not read, except doc_id and text; columns of
    `carry` named n_words, n_removed or kept_text are replaced.
    """
    carry = carry or ["doc_id"]
    taken = [c for c in carry if c in ("block", "n_words", "n_removed", "kept_text")]
    if taken:
        # under other names meanwhile; n_words, n_removed and kept_text of the result take the place of such columns
        names = {c: spare([*docs.columns, *carry], c) for c in taken}
        done = remove_repeats(docs.withColumnsRenamed(names), [names.get(c, c) for c in carry], length, block_bytes)
        return done.drop(*(names[c] for c in taken if c != "block")).withColumnsRenamed({names[c]: c for c in taken if c == "block"})
    columns = list(dict.fromkeys(["doc_id", "text", *carry]))
    blocked, blocks, size = in_blocks(docs.select(*columns), columns, block_bytes)
    text = blocked.select("block", "text")
    shards = max(64, size // SHARD_BYTES)
    sent_schema = "block long, shard long, hashes binary, again binary"

    def passages(part: pa.Table) -> Iterator[Passages]:
        only()
        for _, _, data, offsets in steps(strings(part.column("text"))):
            yield Passages(data, offsets, length)

    def gathered(part: pa.Table, width: int, of: Callable[[Passages], np.ndarray]) -> np.ndarray:
        return np.concatenate([np.zeros((0, width), np.uint64), *(of(p).reshape(-1, width) for p in passages(part))])

    def known(part: pa.Table, level: int) -> np.ndarray:
        here = part.filter(pc.equal(part.column("level"), level))
        return np.sort(unpacked(here.column("hashes")))

    def first_level(part: pa.Table) -> pa.Table:
        return to_shards(part.column("block")[0].as_py(), gathered(part, 1, Passages.chosen), shards)

    def second_level(part: pa.Table, back: pa.Table) -> pa.Table:
        short = known(back, 1)

        def of(p: Passages) -> np.ndarray:
            half, left, right = p.halves(p.candidates(short))
            return half[np.unique(np.concatenate([left, right]))]

        return to_shards(part.column("block")[0].as_py(), gathered(part, 1, of) if len(short) else np.zeros((0, 1), np.uint64), shards)

    def third_level(part: pa.Table, back: pa.Table) -> pa.Table:
        short, halves = known(back, 1), known(back, 2)

        def of(p: Passages) -> np.ndarray:
            half, left, right = p.halves(p.candidates(short))
            return p.whole(left[sorted_in(half[left], halves) & sorted_in(half[right], halves)])

        return to_shards(part.column("block")[0].as_py(), gathered(part, 2, of) if len(halves) else np.zeros((0, 2), np.uint64), shards)

    def last(part: pa.Table, back: pa.Table) -> pa.Table:
        pairs, _ = counted(unpacked(back.column("hashes")).reshape(-1, 2))
        texts = strings(part.column("text"))
        n_words, n_removed, out = [], [], []
        for p in passages(part):
            total = len(p.starts)
            gone = np.zeros(total, bool)
            if len(pairs) and p.valid.any():
                whole = p.whole()
                at = np.flatnonzero(p.valid & sorted_in(whole[:, 0], pairs[:, 0]))
                at = at[pair_in(whole[at], pairs)]
                change = np.zeros(total + 1, np.int32)
                change[at] += 1
                np.subtract.at(change, at + length, 1)
                gone = np.cumsum(change[:-1]) > 0
            stay = np.flatnonzero(~gone)
            data, starts, ends = joined_words(p.data, p.starts[stay], p.ends[stay])
            first = np.searchsorted(stay, p.first)
            n_words.append(np.diff(p.first))
            n_removed.append(np.diff(p.first) - np.diff(first))
            starts, ends = np.append(starts, len(data)), np.append(ends, len(data))
            raw = data.tobytes()
            out += [raw[starts[a] : ends[b - 1]].decode() if b > a else "" for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)]
        assert len(out) == len(texts)
        return pa.table([*(part.column(c) for c in carry), pa.array(np.concatenate(n_words), pa.int64()), pa.array(np.concatenate(n_removed), pa.int64()), pa.array(out, pa.string())], names=[*carry, "n_words", "n_removed", "kept_text"])

    def join(left: DataFrame, back: DataFrame, run: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
        return left.groupBy("block").cogroup(back.groupBy("block")).applyInArrow(run, schema)

    one = kept(repeated(text.groupBy("block").applyInArrow(first_level, sent_schema), False).withColumn("level", F.lit(1)), "repeats-quarter")
    two = kept(repeated(join(text, one, second_level, sent_schema), False).withColumn("level", F.lit(2)), "repeats-half")
    three = kept(repeated(join(text, one.unionByName(two), third_level, sent_schema), True), "repeats-whole")
    types = {f.name: f.dataType.simpleString() for f in docs.schema}
    schema = ", ".join([*(f"`{c}` {types[c]}" for c in carry), "n_words long, n_removed long, kept_text string"])
    return join(blocked, three, last, schema)


def pair_in(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which pairs are in a table of pairs that is sorted by both halves."""
    low = np.searchsorted(known[:, 0], values[:, 0], "left")
    high = np.searchsorted(known[:, 0], values[:, 0], "right")
    found = np.zeros(len(values), bool)
    for k in range(int((high - low).max(initial=0))):
        at = low + k
        ok = at < high
        found[ok] |= known[at[ok], 1] == values[ok, 1]
    return found
