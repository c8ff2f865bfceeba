"""Packing of token pieces into sequences: few-document length patterns fitted by non-negative least squares.

Only lengths matter for packing, and there are at most `capacity` of them, so the fit works on their histogram: patterns
of up to three lengths that fill a sequence exactly get repeat counts by non-negative least squares, these are rounded
down, and what is left is packed by best fit in decreasing order. Pieces then take the places of the plan by their rank
within their length. The plan's size hangs on the capacity alone, not on the number of documents.
"""

from __future__ import annotations

import base64
import bisect
import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import HELD, kept, only, spare, strings

CAPACITY = 2048
#: Pieces for each part into which ranks within a length are split.
RANK_ROWS = 1_000_000
#: Words whose ids a Python worker keeps.
CACHE_WORDS = 600_000


class WordEncoder:
    """Ids of whole texts, put together from the ids of their space-separated parts.

    The tokenizer's own splitting gives the last space of a run of white space to the word that follows it, so a part
    that starts with one space and isn't white space alone can be encoded by itself. Texts in which white space alone
    stands between two spaces or after the last one are encoded whole, and so are texts with a special token's string,
    which the tokenizer turns into that token.

    ranks_path names the same vocabulary as byte-pair ranks, if there is one. New words are then encoded from it, joined
    by line ends, which are tokens of their own there: the same ids in a quarter of the time.
    """

    #: White space alone between two spaces, or after the last space.
    RUN = re.compile(r" \s*(?: |\Z)")

    def __init__(self, tokenizer_path: str, ranks_path: str | None = None):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, special)) or r"(?!)")
        self.known: dict[str, bytes] = {}
        self.ranks = None
        if ranks_path:
            import public_tokenizers
            import tiktoken

            with open(ranks_path, "rb") as lines:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self.ranks = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
            self.line_end = ranks[b"\n"]

    def words(self, words: list[str]) -> list[bytes]:
        """Ids of words that each follow one space."""
        if not self.ranks:
            return self.raw([" " + w for w in words])
        plain = [w.isprintable() and len(w.split()) == 1 for w in words]
        joined = "".join(f" {w}\n" for w, ok in zip(words, plain, strict=True) if ok)
        ids = np.array(self.ranks.encode_ordinary(joined), np.uint32)
        ends = np.flatnonzero(ids == self.line_end)
        assert len(ends) == sum(plain)
        raw, at, out = ids.tobytes(), 0, []
        ends = iter((4 * ends).tolist())
        for w, ok in zip(words, plain, strict=True):
            if ok:
                end = next(ends)
                out.append(raw[at:end])
                at = end + 4
            else:
                out.append(np.array(self.ranks.encode_ordinary(" " + w), np.uint32).tobytes())
        return out

    def raw(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, np.uint32).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids as little-endian unsigned 32-bit numbers."""
        parts = [None if self.RUN.search(t) or self.special.search(t) else t.split(" ") for t in texts]
        heads = [p[0] for p in parts if p]
        words = set(chain.from_iterable(p[1:] for p in parts if p))
        new = [w for w in words if w not in self.known]
        found = dict(zip(new, self.words(new), strict=True))
        if len(self.known) < CACHE_WORDS:
            self.known.update(found)
            get = self.known.__getitem__
        else:
            known = self.known
            get = lambda w: known.get(w) or found[w]
        first = iter(self.raw(heads))
        odd = iter(self.raw([t for t, p in zip(texts, parts, strict=True) if not p]))
        return [b"".join([next(first), *map(get, p[1:])]) if p else next(odd) for p in parts]


ENCODERS: dict[tuple[str, str | None], WordEncoder] = {}
HELD["packing"] = ENCODERS.clear


def encoder(path: str, ranks_path: str | None = None) -> WordEncoder:
    if (path, ranks_path) not in ENCODERS:
        ENCODERS[path, ranks_path] = WordEncoder(path, ranks_path)
    return ENCODERS[path, ranks_path]


def token_pieces(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end_id: int = 0, with_ids: bool = False, ranks_path: str | None = None) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]): each text's ids and end_id, longer ones cut so that only the first piece may be short."""
    schema = "doc_id long, piece int, start long, length int, ids_crc32 long" + ", ids binary" * with_ids
    end = np.array([end_id], np.uint32).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only("packing")
        encode = encoder(tokenizer_path, ranks_path).encode
        for batch in batches:
            doc_ids, texts = batch.column(0).to_pylist(), strings(batch.column(1))
            for at in range(0, len(doc_ids), 500):
                rows = []
                for doc_id, ids in zip(doc_ids[at : at + 500], encode(texts[at : at + 500].to_pylist()), strict=True):
                    ids += end
                    total, start, piece = len(ids) // 4, 0, 0
                    while start < total:
                        length = (total - start) % capacity or capacity
                        part = ids[4 * start : 4 * (start + length)]
                        rows.append((doc_id, piece, start, length, zlib.crc32(part), part)[: 5 + with_ids])
                        start, piece = start + length, piece + 1
                columns = list(zip(*rows, strict=True)) or [[]] * (5 + with_ids)
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=False)], names=[x.split()[0] for x in schema.split(", ")])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(run, schema)


def exact_patterns(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """All patterns a >= b >= c of two or three of the lengths that sum to the capacity (two: c is 0)."""
    there = np.zeros(capacity + 1, bool)
    there[lengths] = True
    found = []
    for c in [0, *np.sort(lengths).tolist()]:
        if 3 * c > capacity:
            break
        b = np.arange(max(c, 1), (capacity - c) // 2 + 1)
        a = capacity - c - b
        ok = there[a] & there[b]
        found.append(np.stack([a[ok], b[ok], np.full(ok.sum(), c)], 1))
    return np.concatenate(found) if found else np.zeros((0, 3), np.int64)


def fitted_counts(histogram: np.ndarray, patterns: np.ndarray, rounds: int = 80) -> np.ndarray:
    """x >= 0 that makes sum of pattern counts close to the histogram in least squares, by coordinate descent.

    Each round moves patterns without common lengths by their exact steps, those with the steepest descent first; few
    patterns get a count at all, as with an active set.
    """
    capacity = len(histogram) - 1
    x = np.zeros(len(patterns))
    if not len(patterns):
        return x
    rest = histogram.astype(float).copy()
    rest[0] = 0
    width = (patterns > 0).sum(1)
    norm = np.zeros(len(patterns))  # squared length of each pattern's column
    for i in range(3):
        norm += (patterns > 0)[:, i] * (patterns == patterns[:, i : i + 1]).sum(1)
    for _ in range(rounds):
        gain = rest[patterns].sum(1)
        step = np.maximum(gain / norm, -x)
        worth = step * step * norm
        order = np.argsort(-worth)[: 8 * capacity]
        order = order[worth[order] > 1e-3]
        if not len(order):
            break
        busy = np.zeros(capacity + 1, bool)
        chosen = []
        for j, (a, b, c) in zip(order.tolist(), patterns[order].tolist(), strict=True):
            if not (busy[a] or busy[b] or c and busy[c]):
                busy[a] = busy[b] = True
                busy[c] = c > 0
                chosen.append(j)
        chosen = np.array(chosen)
        x[chosen] += step[chosen]
        for i in range(3):
            np.subtract.at(rest, patterns[chosen, i], step[chosen])
        rest[0] = 0
    assert width.min() >= 2
    return x


def best_fit(histogram: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best fit, longest first, on counts: bins with equal content are handled together."""
    groups: dict[int, dict[tuple[int, ...], int]] = {}
    spaces: list[int] = []

    def put(space: int, content: tuple[int, ...], n: int) -> None:
        if space not in groups:
            groups[space] = {}
            bisect.insort(spaces, space)
        groups[space][content] = groups[space].get(content, 0) + n

    for length in np.flatnonzero(histogram)[::-1].tolist():
        left = int(histogram[length])
        while left:
            i = bisect.bisect_left(spaces, length)
            if i == len(spaces):
                per = capacity // length
                bins, odd = divmod(left, per)
                if bins:
                    put(capacity - per * length, (length,) * per, bins)
                if odd:
                    put(capacity - odd * length, (length,) * odd, 1)
                break
            space = spaces[i]
            content, n = groups[space].popitem()
            if not groups[space]:
                del groups[space], spaces[i]
            take = min(n, left)
            put(space - length, (*content, length), take)
            if n > take:
                put(space, content, n - take)
            left -= take
    return [(content, n) for g in groups.values() for content, n in g.items()]


def packing_plan(histogram: np.ndarray, capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """Patterns and how many sequences follow each; every length is used just as often as the histogram says."""
    rest = histogram.astype(np.int64).copy()
    rest[0] = 0
    plan: list[tuple[tuple[int, ...], int]] = []
    if rest[capacity]:
        plan.append(((capacity,), int(rest[capacity])))
        rest[capacity] = 0
    patterns = exact_patterns(np.flatnonzero(rest), capacity)
    counts = np.floor(fitted_counts(rest, patterns) + 1e-9).astype(np.int64)
    for j in np.argsort(-counts).tolist():
        if counts[j] <= 0:
            break
        content = tuple(v for v in patterns[j].tolist() if v)
        n = int(min(counts[j], *(rest[v] // content.count(v) for v in content)))
        if n > 0:
            plan.append((content, n))
            for v in content:
                rest[v] -= n
    return plan + best_fit(rest, capacity)


class Places:
    """For each length, its places in the plan by rank."""

    def __init__(self, plan: list[tuple[tuple[int, ...], int]], capacity: int):
        slots: list[list[tuple[int, int, int]]] = [[] for _ in range(capacity + 1)]
        base = 0
        for content, n in plan:
            offset = 0
            for v in content:
                slots[v].append((n, base, offset))
                offset += v
            base += n
        self.first = np.cumsum([0, *(len(s) for s in slots)])
        flat = np.array([t for s in slots for t in s] or [(0, 0, 0)], np.int64)
        ends = np.concatenate([np.cumsum([t[0] for t in s], dtype=np.int64) for s in slots])
        self.begin = ends - flat[: len(ends), 0]
        self.base, self.offset = flat[:, 1], flat[:, 2]
        # one sorted array for all lengths: rank + length * stride
        self.stride = int(ends.max(initial=0)) + 1
        self.keys = np.repeat(np.arange(capacity + 1), np.diff(self.first)) * self.stride + self.begin

    def of(self, lengths: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self.keys, lengths * self.stride + ranks, "right") - 1
        return self.base[at] + ranks - self.begin[at], self.offset[at]


def pack(pieces: DataFrame, capacity: int = CAPACITY, rank_rows: int = RANK_ROWS) -> DataFrame:
    """pieces (doc_id, piece, length, ...) with sequence_id and offset.

    Each sequence is filled gapless from 0 with at most `capacity` tokens. Ranks within a length are counted in parts by
    a hash of doc_id and piece, so a length that very many pieces share is spread over tasks. Rows with null or repeated
    doc_id are pieces like others; columns named sequence_id or offset are replaced; an empty table gives an empty result.
    """
    spark = pieces.sparkSession
    pieces = pieces.drop("sequence_id", "offset")
    columns = pieces.columns
    part, rank, n, ahead = (spare(columns, x) for x in ("part", "rank", "n", "ahead"))
    histogram = np.zeros(capacity + 1, np.int64)
    for r in pieces.groupBy("length").count().collect():  # at most `capacity` rows
        histogram[r["length"]] = r["count"]
    places = spark.sparkContext.broadcast(Places(packing_plan(histogram, capacity), capacity))
    parts = max(64, int(histogram.sum()) // rank_rows)
    salted = pieces.withColumn(part, F.pmod(F.xxhash64("doc_id", "piece"), F.lit(parts)))
    before = salted.groupBy("length", part).agg(F.count(F.lit(1)).alias(n))
    before = before.select("length", part, (F.sum(n).over(Window.partitionBy("length").orderBy(part)) - F.col(n)).alias(ahead))
    ranked = salted.withColumn(rank, F.row_number().over(Window.partitionBy("length", part).orderBy("doc_id", "piece")) - 1)
    ranked = ranked.join(before, ["length", part]).select(*(f"`{c}`" for c in columns), (F.col(rank) + F.col(ahead)).cast("long").alias(rank))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lengths = b.column(b.schema.get_field_index("length")).to_numpy(zero_copy_only=False).astype(np.int64)
            sequence, offset = places.value.of(lengths, b.column(len(columns)).to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(sequence), pa.array(offset)], names=[*columns, "sequence_id", "offset"])

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema] + ["sequence_id long", "offset long"])
    return ranked.mapInArrow(run, schema)


def packed_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, ranks_path: str | None = None, with_ids: bool = False) -> DataFrame:
    """All texts as pieces with their places (null text: empty, which is one piece of the end id alone).

    with_ids adds the pieces' ids, as little-endian unsigned 32-bit numbers. A very long text becomes many full pieces;
    null and repeated doc_ids are documents like others; an empty table gives an empty result; further columns of docs
    are not read.
    """
    pieces = token_pieces(docs, tokenizer_path, id_col, text_col, capacity, with_ids=with_ids, ranks_path=ranks_path)
    return pack(kept(pieces, "pieces"), capacity)
