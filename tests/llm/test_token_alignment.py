import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import sentencepiece
from tokenizers import Tokenizer

from tallyloom.llm import token_alignment
from tallyloom.llm.queries import op13_token_alignment
from tallyloom.llm.token_alignment import align_tokens, coalesced, grouped, links

A, B, RANKS = (public_tokenizers.path(x) for x in ("byte_bpe_50k.json", "piece_bpe_32k.model", "byte_bpe_50k.tiktoken"))
TOKENIZER = Tokenizer.from_file(A)
TOKENIZER.encode_special_tokens = True
PIECES = sentencepiece.SentencePieceProcessor(model_file=B)


def letters():
    """The byte of each letter of a byte-level vocabulary, as its authors define it: printable bytes stand for themselves."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


LETTERS = letters()


def plain_tokens(text):
    """(A ids, A ends, B ids, B ends) of one whole text."""
    if not text:
        return [], [], [], []
    want = (" " + text).encode()
    a = TOKENIZER.encode(" " + text, add_special_tokens=False).ids
    b = PIECES.encode(text)
    parts_a = [bytes(LETTERS[c] for c in TOKENIZER.id_to_token(i)) for i in a]
    parts_b = [bytes([int(p[3:5], 16)]) if len(p) == 6 and p.startswith("<0x") else p.replace("▁", " ").encode() for p in map(PIECES.id_to_piece, b)]
    if b"".join(parts_a) != want or b"".join(parts_b) != want:
        return [], [], [], []
    return a, np.cumsum([len(x) for x in parts_a]).tolist(), b, np.cumsum([len(x) for x in parts_b]).tolist()


def plain_groups(text):
    a, a_ends, b, b_ends = plain_tokens(text)
    out, i, j = [], 0, 0
    for end in sorted(set(a_ends) & set(b_ends)):
        k, m = a_ends.index(end, i) + 1, b_ends.index(end, j) + 1
        out.append((a[i:k], b[j:m]))
        i, j = k, m
    return a, b, out


def plain(texts):
    whole = [plain_groups(t or "") for t in texts]
    linked = [Counter((x, y) for xs, ys in groups for x in xs for y in ys) for _, _, groups in whole]
    count = Counter(p for own in linked for p in own)
    most = defaultdict(int)
    for (x, _), n in count.items():
        most[x] = max(most[x], n)
    rows = []
    for (a, b, groups), own in zip(whole, linked, strict=True):
        text = ";".join(f"{','.join(map(str, xs))}|{','.join(map(str, ys))}" for xs, ys in groups)
        best = sum(k for p, k in own.items() if count[p] == most[p[0]])
        rows.append((len(a), len(b), len(groups), sum(own.values()), best, sum(k * count[p] for p, k in own.items()), text))
    return rows


def got(frame):
    return sorted(((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups) for r in frame.collect()), key=str)


def test_query_against_plain(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    want = {d.doc_id: row for d, row in zip(docs, plain([d.text for d in docs]), strict=True)}
    rows = op13_token_alignment(spark, sf).collect()
    assert len(rows) == len(docs)
    for r in rows:
        *numbers, text = want[r.doc_id]
        assert [r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum] == numbers
        assert r.groups_sha256 == (hashlib.sha256(text.encode()).hexdigest() if text else "")


ODD = ["<|endoftext|> x <s> </s> <unk>", "a ▁ b", "  two  spaces ", "\n", " ", "tab\tand\nlines\r\n", "<0x41>", "naïve Ünï 1234567 don't", "日本語のテキスト。 とても", "😀👩‍👩‍👧 👍🏽x", "\x00\x01 \x1c x", "ﬁ ﬀ ½ Ⅳ", "é é", "a" * 3000, "x" * 200 + " y", "no break", "word\n next 　 z", "​﻿"]


def test_odd_texts_in_small_blocks(spark):
    rng = random.Random(8)
    parts = [*ODD, " ", "  ", "\n", "word", " the", "'s", "12", "▁", "é", "ab", "😀"]
    texts = ODD + ["".join(rng.choices(parts, k=rng.randrange(1, 12))) for _ in range(300)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = sorted([(i, *row) for i, row in enumerate(plain(texts))], key=str)
    assert got(align_tokens(frame, A, B, ranks_path=RANKS, block_bytes=2000)) == want
    assert got(align_tokens(frame, A, B)) == want


def test_groups_with_many_links(monkeypatch):
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 9, 400), rng.integers(0, 9, 500)
    size = np.ones(9, np.int64)
    g = grouped(np.append(a, 8), np.array([0, 401]), np.concatenate([b[:401], []]).astype(np.int64), np.array([0, 401]), size, size)
    g.a_group[:], g.b_group[:] = np.arange(401) // 100, np.arange(401) // 100
    few = Counter()
    for group, pair, times in zip(*links(g), strict=True):
        few[group, pair] += times
    monkeypatch.setattr(token_alignment, "MANY", 3)
    many = Counter()
    for group, pair, times in zip(*links(g), strict=True):
        many[group, pair] += times
    assert few == many and sum(few.values()) == 4 * 100 * 100 + 1


def test_coalescing():
    a, b = coalesced(np.array([2, 3, 7, 9, 10]), np.array([3, 5, 9, 10]))
    assert a.tolist() == [0, 0, 1, 1, 2] and b.tolist() == [0, 1, 1, 2]
    assert [len(x) for x in coalesced(np.zeros(0, np.int64), np.zeros(0, np.int64))] == [0, 0]


def test_edges(spark):
    long = "Many different words, and few. " * 20000 + "ab" * 100000
    rows = [(1, None), (2, ""), (None, "no id"), (3, "same text"), (3, "same text"), (4, long), (5, "a ▁ b")]
    frame = spark.createDataFrame([(*r, 1, 2, "x") for r in rows], "doc_id long, text string, block int, a int, pairs string")
    assert got(align_tokens(frame, A, B, ranks_path=RANKS)) == sorted([(r[0], *row) for r, row in zip(rows, plain([t for _, t in rows]), strict=True)], key=str)
    assert align_tokens(frame.limit(0), A, B).count() == 0
    nothing = frame.filter("text = ''")
    assert got(align_tokens(nothing, A, B)) == [(2, 0, 0, 0, 0, 0, 0, "")]
