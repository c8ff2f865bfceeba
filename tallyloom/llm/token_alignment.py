"""Alignment of two tokenizers' tokens over the same bytes, and how often an aligned pair of ids occurs in the corpus.

Tokens are byte intervals. All A and B tokens of a step are sorted by start (lexsort) and the running maximum of their ends
is taken (maximum.accumulate): a group ends where a start reaches the maximum, which is where tokens of both sides end.
Every A token of a group is linked with every B token of it.

Both tokenizers end a token before a space that follows something else, so a text falls into units (a space and what
follows up to the next one) whose groups are the text's groups. A step aligns its different units once; a text is a list of
units, and a unit that very many documents share costs nothing more. Texts with white space alone between or after spaces
are one unit.

Documents form blocks of a few MB. A block sends each different id pair once, with the number of its documents that hold
it; the sums are joined back by block, so what travels grows with a block's different pairs and not with its tokens.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .pattern_packing import WordEncoder
from .shared import HELD, kept, only, packed, steps, strings

#: Text bytes of a block: what one task aligns at once and looks up together.
BLOCK_BYTES = 4 << 20
#: Links of a group above which its ids are counted before they are linked.
MANY = 4096


class Pair:
    """The two tokenizers of one worker: ids and bytes of units, each of which follows one space."""

    RUN = re.compile(r" \s*(?: |\Z)")
    BYTE = re.compile(r"<0x([0-9A-F]{2})>")

    def __init__(self, tokenizer_path: str, pieces_path: str, ranks_path: str | None):
        import sentencepiece
        from tokenizers.pre_tokenizers import ByteLevel

        self.a = WordEncoder(tokenizer_path, ranks_path)
        self.a.tokenizer.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=pieces_path)
        visible = {c: i for i, c in enumerate(byte_letters())}
        assert set(visible) == set(ByteLevel.alphabet())
        size = self.a.tokenizer.get_vocab_size()
        self.a_bytes = [bytes(map(visible.__getitem__, self.a.tokenizer.id_to_token(i) or "")) if set(self.a.tokenizer.id_to_token(i) or "") <= set(visible) else b"" for i in range(size)]
        self.b_bytes = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            byte = self.BYTE.fullmatch(piece)
            self.b_bytes.append(bytes([int(byte[1], 16)]) if byte else piece.replace("▁", " ").encode())
        self.a_size = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_size = np.array([len(x) for x in self.b_bytes], np.int64)
        a_names, b_names = map(str, range(size)), map(str, range(len(self.b_bytes)))
        self.names = np.array([x + mark for names, marks in ((list(a_names), ",|"), (list(b_names), ",;")) for mark in marks for x in names], object)

    def units(self, text: str) -> list[str]:
        """The parts that each follow one space in space+text; no text has none."""
        if not text:
            return []
        return [text] if self.RUN.search(" " + text) else text.split(" ")

    def tokens(self, units: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """A ids, each unit's first one (one more entry than units), and the same of B; none of a unit whose joined bytes aren't those of space+unit."""
        single = [" " not in u for u in units]
        words = iter(self.a.words([u for u, ok in zip(units, single, strict=True) if ok]))
        texts = iter(self.a.raw([" " + u for u, ok in zip(units, single, strict=True) if not ok]))
        a = [next(words) if ok else next(texts) for ok in single]
        b = self.b.encode(units, num_threads=1) if units else []
        a_ids, a_n = np.frombuffer(b"".join(a), np.uint32).astype(np.int64), np.array([len(x) // 4 for x in a], np.int64)
        b_n = np.array([len(x) for x in b], np.int64)
        b_ids = np.fromiter(chain.from_iterable(b), np.int64, int(b_n.sum()))
        want = [b" " + u.encode() for u in units]
        size, whole = np.array([len(x) for x in want], np.int64), b"".join(want)
        fits = np.ones(len(units), bool)
        for ids, n, sizes, table in ((a_ids, a_n, self.a_size, self.a_bytes), (b_ids, b_n, self.b_size, self.b_bytes)):
            unit = np.repeat(np.arange(len(units)), n)
            fits &= np.bincount(unit, sizes[ids], len(units)).astype(np.int64) == size
            if b"".join(map(table.__getitem__, ids.tolist())) != whole:
                ends = np.cumsum(n)
                fits &= [b"".join(map(table.__getitem__, ids[e - k : e].tolist())) == w for e, k, w in zip(ends.tolist(), n.tolist(), want, strict=True)]
        if not fits.all():
            a_ids, b_ids = a_ids[np.repeat(fits, a_n)], b_ids[np.repeat(fits, b_n)]
            a_n, b_n = a_n * fits, b_n * fits
        return a_ids, np.concatenate([[0], np.cumsum(a_n)]), b_ids, np.concatenate([[0], np.cumsum(b_n)])


def byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies: itself where it is printable, else the next free code point from 256 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


PAIRS: dict[tuple[str, str, str | None], Pair] = {}
HELD["alignment"] = PAIRS.clear


def pair_of(*paths: str | None) -> Pair:
    if paths not in PAIRS:
        PAIRS[paths] = Pair(*paths)
    return PAIRS[paths]


@dataclass
class Groups:
    """Groups of a run of units, by their tokens: ids in order, each token's group, and each unit's first token and group (one more entry than units)."""

    a: np.ndarray
    b: np.ndarray
    a_group: np.ndarray
    b_group: np.ndarray
    a_first: np.ndarray
    b_first: np.ndarray
    first: np.ndarray


def coalesced(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each A and each B token's group, given the ends of tokens that follow one another from 0 on both sides.

    All intervals in order of start; a group breaks where a start reaches the running maximum of the ends before it.
    """
    ends = np.concatenate([a_ends, b_ends])
    starts = np.concatenate([np.append(0, a_ends)[:-1], np.append(0, b_ends)[:-1]])
    order = np.lexsort((ends, starts))
    most = np.maximum.accumulate(ends[order])
    breaks = np.zeros(len(ends), np.int64)
    breaks[1:] = starts[order][1:] >= most[:-1]
    group = np.empty(len(ends), np.int64)
    group[order] = np.cumsum(breaks)
    return group[: len(a_ends)], group[len(a_ends) :]


def grouped(a: np.ndarray, a_first: np.ndarray, b: np.ndarray, b_first: np.ndarray, a_size: np.ndarray, b_size: np.ndarray) -> Groups:
    """Groups of units that are laid one behind another; a unit has the same bytes on both sides, so no group spans two."""
    a_group, b_group = coalesced(np.cumsum(a_size[a]), np.cumsum(b_size[b]))
    total = int(a_group[-1]) + 1 if len(a_group) else 0
    return Groups(a, b, a_group, b_group, a_first, b_first, np.append(a_group, total)[a_first])


def links(g: Groups) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(group, A id << 32 | B id, times) for the links of each group; ids of a group with very many links are counted first."""
    total = int(g.a_group[-1]) + 1 if len(g.a_group) else 0
    n_a, n_b = np.bincount(g.a_group, minlength=total), np.bincount(g.b_group, minlength=total)
    large = np.flatnonzero(n_a * n_b > MANY)
    b_at = np.concatenate([[0], np.cumsum(n_b)])
    mine = g.a_group
    if len(large):
        mine = mine[~np.isin(mine, large)]
        a_ids = g.a[~np.isin(g.a_group, large)]
    else:
        a_ids = g.a
    times = n_b[mine]
    group = np.repeat(mine, times)
    place = np.arange(len(group)) - np.repeat(np.cumsum(times) - times, times) + np.repeat(b_at[mine], times)
    out = [(group, np.repeat(a_ids, times) << 32 | g.b[place], np.ones(len(group), np.int64))]
    a_at = np.concatenate([[0], np.cumsum(n_a)])
    for k in large.tolist():
        x, n_x = np.unique(g.a[a_at[k] : a_at[k + 1]], return_counts=True)
        y, n_y = np.unique(g.b[b_at[k] : b_at[k + 1]], return_counts=True)
        out.append((np.full(len(x) * len(y), k), (x[:, None] << 32 | y).ravel(), np.outer(n_x, n_y).ravel()))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))  # type: ignore[return-value]


def unit_links(g: Groups) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(unit, pair, times): the different links of each unit, in order."""
    group, pair, times = links(g)
    unit = np.searchsorted(g.first, group, "right") - 1
    order = np.lexsort((pair, unit))
    unit, pair, times = unit[order], pair[order], times[order]
    new = np.ones(len(unit), bool)
    new[1:] = (unit[1:] != unit[:-1]) | (pair[1:] != pair[:-1])
    at = np.flatnonzero(new)
    return unit[at], pair[at], np.add.reduceat(times, at) if len(at) else times


def group_texts(g: Groups, names: np.ndarray, n_a: int, n_b: int) -> list[str]:
    """Each unit's groups as `a1,a2|b1`, joined by semicolons; names are the A ids with comma and bar, then the B ids with comma and semicolon."""
    last_a, last_b = np.ones(len(g.a), bool), np.ones(len(g.b), bool)
    last_a[:-1], last_b[:-1] = g.a_group[1:] != g.a_group[:-1], g.b_group[1:] != g.b_group[:-1]
    order = np.argsort(np.concatenate([2 * g.a_group, 2 * g.b_group + 1]), kind="stable")
    written = names[np.concatenate([g.a + n_a * last_a, 2 * n_a + g.b + n_b * last_b])[order]].tolist()
    at = (g.a_first + g.b_first).tolist()
    return ["".join(written[i:j])[:-1] for i, j in zip(at, at[1:], strict=False)]


def distinct_pairs(units: list[np.ndarray], unit: np.ndarray, pair: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(pair, number of documents that hold it) over documents given by their units."""
    first = np.searchsorted(unit, np.arange(int(unit[-1]) + 2 if len(unit) else 1))
    names, code = np.unique(pair, return_inverse=True)
    seen = []
    for own in units:  # a document's different units, then their different pairs
        own = np.unique(own)
        own = own[own < len(first) - 1]
        n = first[own + 1] - first[own]
        place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first[own], n)
        seen.append(np.unique(code[place]))
    count = np.bincount(np.concatenate([*seen, np.zeros(0, np.int64)]).astype(np.int64), minlength=len(names))
    return names[count > 0], count[count > 0]


def small(values: np.ndarray) -> bytes:
    """An array of numbers in as few bytes each as its largest needs, after a byte that tells how many."""
    most = int(values.max()) if len(values) else 0
    kind = np.uint8 if most < 1 << 8 else np.uint16 if most < 1 << 16 else np.uint32
    return bytes([np.dtype(kind).itemsize]) + packed(values.astype(kind))


def large(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, f"<u{raw[0]}", offset=1).astype(np.int64)


ALIGNED = "block long, doc_id long, units binary, a binary, a_n binary, b binary, b_n binary, pairs array<long>, docs array<int>"


def aligned_blocks(docs: DataFrame, paths: tuple[str, str, str | None], block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Documents as lists of their block's units, and a row a block with its units' tokens and its different pairs."""
    kinds = [pa.int64(), pa.int64(), *[pa.binary()] * 5, pa.list_(pa.int64()), pa.list_(pa.int32())]
    schema = pa.schema([(x.split()[0], kind) for x, kind in zip(ALIGNED.split(", "), kinds, strict=True)])

    def block(number: int, held: list[tuple[pa.Array, list[str]]]) -> Iterator[pa.RecordBatch]:
        pair = pair_of(*paths)
        of = [pair.units(t) for _, texts in held for t in texts]
        names = list({u: None for own in of for u in own})
        code = {u: i for i, u in enumerate(names)}
        tokens = pair.tokens(names)
        whole = np.diff(tokens[1]) > 0
        units = [np.array([code[u] for u in own], np.uint32) for own in of]
        units = [own if whole[own].all() else own[:0] for own in units]
        pairs, count = distinct_pairs(units, *unit_links(grouped(*tokens, pair.a_size, pair.b_size))[:2])
        rows = [pa.array([number] * len(of)), pa.concat_arrays([x for x, _ in held]), pa.array([small(x) for x in units], pa.binary())]
        yield pa.RecordBatch.from_arrays([*rows, *(pa.nulls(len(of), kind) for kind in kinds[3:])], schema=schema)
        row = [number, None, None, *(small(x) for x in (tokens[0], np.diff(tokens[1]), tokens[2], np.diff(tokens[3]))), pairs, count]
        yield pa.RecordBatch.from_arrays([pa.array([x], kind) for x, kind in zip(row, kinds, strict=True)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only("alignment")
        number = TaskContext.get().partitionId() << 32
        held: list[tuple[pa.Array, list[str]]] = []
        size = 0
        for b in batches:
            texts = strings(b.column(1))
            for first, end, data, _ in steps(texts, block_bytes // 4):
                held.append((b.column(0)[first:end], texts[first:end].to_pylist()))
                size += len(data)
                if size >= block_bytes:
                    yield from block(number, held)
                    held, size, number = [], 0, number + 1
        if held:
            yield from block(number, held)

    return docs.mapInArrow(run, ALIGNED)


def pair_counts(blocks: DataFrame) -> DataFrame:
    """(block, pair, count, best): the documents that hold each of a block's pairs, corpus-wide, and whether no pair of its A id has more."""
    own = blocks.filter("pairs is not null").select("block", F.explode(F.arrays_zip("pairs", "docs")).alias("x")).select("block", F.col("x.pairs").alias("pair"), F.col("x.docs").alias("docs"))
    count = kept(own.groupBy("pair").agg(F.sum("docs").alias("count")), "pair-counts")
    most = count.groupBy(F.shiftright("pair", 32).alias("a")).agg(F.max("count").alias("most"))
    count = count.withColumn("a", F.shiftright("pair", 32)).join(most, "a").select("pair", "count", (F.col("count") == F.col("most")).alias("best"))
    return own.select("block", "pair").join(count, "pair").select("block", "pair", "count", "best")


def align_tokens(docs: DataFrame, tokenizer_path: str, pieces_path: str, id_col: str = "doc_id", text_col: str = "text", ranks_path: str | None = None, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups): each text's aligned groups and how usual their links are.

    groups is `a1,a2|b1;a3|b2,b3`: the A and B ids of each group in order. n_links counts linked occurrences, n_best those
    whose pair has the highest count of its A id, count_sum is the sum of the pairs' counts; a pair's count is the number
    of documents that hold it. ranks_path may name A's vocabulary as byte-pair ranks, which is faster.

    Null and empty texts, and texts whose bytes either tokenizer doesn't give back, have no tokens: zeros and an empty
    groups text. Special tokens' strings are ordinary text. Repeated rows are documents of their own; null ids are rows like
    others; a very long text is a block of its own; an empty table gives an empty result; other columns are not read.
    """
    paths = (tokenizer_path, pieces_path, ranks_path)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    blocks = kept(aligned_blocks(rows, paths, block_bytes), "aligned")

    def answer(left: pa.Table, right: pa.Table) -> pa.Table:
        only("alignment")
        pair = pair_of(*paths)
        is_doc = pc.is_valid(left["units"])
        rows, own = left.filter(is_doc), left.filter(pc.invert(is_doc)).to_pylist()[0]
        a, a_n, b, b_n = (large(own[c]) for c in ("a", "a_n", "b", "b_n"))
        g = grouped(a, np.append(0, np.cumsum(a_n)), b, np.append(0, np.cumsum(b_n)), pair.a_size, pair.b_size)
        unit, codes, times = unit_links(g)
        order = np.argsort(right["pair"].to_numpy())
        known = right["pair"].to_numpy()[order]
        at = np.minimum(np.searchsorted(known, codes), max(0, len(known) - 1))
        there = known[at] == codes if len(known) else np.zeros(len(codes), bool)  # pairs of broken texts alone aren't there
        count = np.where(there, right["count"].to_numpy()[order][at], 0) if len(known) else np.zeros(len(codes), np.int64)
        best = there & right["best"].to_numpy(zero_copy_only=False)[order][at] if len(known) else there
        by_unit = np.zeros((6, len(g.a_first) - 1), np.int64)
        by_unit[0], by_unit[1], by_unit[2] = np.diff(g.a_first), np.diff(g.b_first), np.diff(g.first)
        np.add.at(by_unit[3], unit, times)
        np.add.at(by_unit[4], unit, times * best)
        np.add.at(by_unit[5], unit, times * count)
        words = group_texts(g, pair.names, len(pair.a_size), len(pair.b_size))
        sums, texts = np.zeros((6, rows.num_rows), np.int64), []
        for i, raw in enumerate(rows["units"].to_pylist()):
            own = large(raw)
            sums[:, i] = by_unit[:, own].sum(1)
            texts.append(";".join([words[u] for u in own.tolist()]))
        return pa.table([rows["doc_id"], *(pa.array(x) for x in sums), pa.array(texts, pa.string())], names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"])

    left = blocks.drop("pairs", "docs").groupBy("block")
    return left.cogroup(pair_counts(blocks).withColumnRenamed("block", "of").groupBy("of")).applyInArrow(answer, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string")
