import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from tallyloom.llm.pattern_packing import Places, WordEncoder, best_fit, exact_patterns, pack, packed_documents, packing_plan, token_pieces

PATH = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def check_pack(rows, docs, capacity=2048):
    tokenizer = Tokenizer.from_file(PATH)
    want = Counter()
    for d, t in docs:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]
        start = piece = 0
        while start < len(ids):
            n = (len(ids) - start) % capacity or capacity
            want[d, piece, start, n, zlib.crc32(np.array(ids[start : start + n], "<u4").tobytes())] += 1
            start, piece = start + n, piece + 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for s in sequences.values():
        at = 0
        for offset, n in sorted(s):
            assert offset == at
            at += n
        assert at <= capacity
    total = sum(n for _, _, _, n, _ in want.elements())
    return len(sequences), -(-total // capacity)


def test_whole_documents(spark, sf):
    frame = spark.read.parquet(f"{sf}/documents.parquet")
    docs = [(r.doc_id, r.text) for r in frame.collect()]
    used, least = check_pack(packed_documents(frame, PATH, ranks_path=RANKS).collect(), docs)
    assert used <= 1.03 * least + 1


def test_edges(spark):
    docs = [(1, None), (2, ""), (3, "  two  spaces "), (None, "x"), (None, "x"), (4, "é\n\n b  \n c  d <|endoftext|> e"), (5, "word " * 9000), (6, " \n "), (7, "a \nb\t c"), (8, "x" * 100000)]
    frame = spark.createDataFrame([(d, t, 1, 2) for d, t in docs], "doc_id long, text string, length int, sequence_id long")
    clash = token_pieces(frame, PATH).selectExpr("*", "1 as _part", "2 as _rank", "3 as offset", "4 as `_N`")
    check_pack(pack(clash).collect(), docs)
    with_ids = packed_documents(frame, PATH, with_ids=True).collect()
    assert all(zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length for r in with_ids)
    check_pack(packed_documents(frame, PATH).collect(), docs)
    check_pack(packed_documents(frame, PATH, ranks_path=RANKS).collect(), docs)
    assert packed_documents(frame.limit(0), PATH).count() == 0


def test_encoder_matches(sf):
    texts = ["a\tb c\td\t e", "x\u00a0 y \u00a0z w\u2028 v", "a\x00 b\x1c c\r d","", " ", "a", " a", "a  b", "don't stop", "x\n y", "x \n\ny z", "1234 5.6!! ..", "ÉÈ ü　 w", "a \xa0 \xa0 b", "x <|endoftext|> y", "<|endoftext|>", "a \n \n b", "a \n", "\n b", " \n b \t"]
    rng = random.Random(3)
    texts += ["".join(rng.choices(" \n\t\xa0\u3000\x85\x1cab.'1é", k=rng.randrange(1, 14))) for _ in range(20000)]
    plain = Tokenizer.from_file(PATH)
    want = [x.ids for x in plain.encode_batch(texts, add_special_tokens=False)]
    for e in (WordEncoder(PATH), WordEncoder(PATH, RANKS)):
        assert [np.frombuffer(x, np.uint32).tolist() for x in e.encode(texts)] == want


def test_plan_uses_each_length_as_often_as_it_is():
    rng = np.random.default_rng(2)
    for capacity, n in ((64, 50), (64, 5000), (2048, 3000), (2048, 300_000), (7, 0)):
        histogram = np.bincount(rng.integers(1, capacity + 1, n), minlength=capacity + 1)
        plan = packing_plan(histogram, capacity)
        used = np.zeros(capacity + 1, np.int64)
        for content, k in plan:
            assert k > 0 and sum(content) <= capacity
            for v in content:
                used[v] += k
        assert (used == histogram).all()
        sequences, least = sum(k for _, k in plan), -(-int((histogram * np.arange(capacity + 1)).sum()) // capacity)
        plain = sum(k for _, k in best_fit(histogram, capacity))
        assert sequences <= max(plain, 1.02 * least) + 1, (sequences, plain, least)


def test_patterns():
    assert sorted(map(tuple, exact_patterns(np.array([1, 2, 3, 5]), 6).tolist())) == [(2, 2, 2), (3, 2, 1), (3, 3, 0), (5, 1, 0)]


def test_places():
    p = Places([((3, 3, 2), 2), ((3,), 1)], 8)
    seq, off = p.of(np.array([3] * 5 + [2] * 2), np.array([0, 1, 2, 3, 4, 0, 1]))
    assert sorted(zip(seq.tolist(), off.tolist(), strict=True)) == [(0, 0), (0, 3), (0, 6), (1, 0), (1, 3), (1, 6), (2, 0)]
