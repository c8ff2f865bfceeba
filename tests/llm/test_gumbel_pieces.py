import math
import tracemalloc
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa

from tallyloom.llm import gumbel_pieces
from tallyloom.llm.gumbel_pieces import Vocabulary, decode_documents, encode_documents, sample_segmentations, sampled
from tallyloom.llm.shared import steps, strings

PATH = public_tokenizers.path("piece_bpe_32k.model")
V = Vocabulary(PATH)
KNOWN = {p: i for i, p in enumerate(V.pieces) if not (p.startswith("<0x") or i < 3)}


def all_segmentations(text):
    """Every way to write a text in pieces, with its probability among all."""
    text = "▁" + text.replace("▁", "\0").replace(" ", "▁")

    def ways(i):
        if i == len(text):
            yield (), 0.0
        for j in range(i + 1, len(text) + 1):
            piece = text[i:j]
            if piece in KNOWN:
                ids, log = (KNOWN[piece],), V.log[KNOWN[piece]]
            elif j == i + 1:
                ids = tuple(V.bytes[b] for b in piece.replace("\0", "▁").encode())
                log = V.byte_log * len(ids)
            else:
                continue
            for rest, more in ways(j):
                yield ids + rest, log + more

    found = dict(ways(0))
    total = math.log(sum(math.exp(x) for x in found.values()))
    return {ids: x - total for ids, x in found.items()}


def test_against_all_segmentations():
    for text in ("the", "a  b", "né ▁x", "\n", "", "日a"):
        every = all_segmentations(text)
        n = 3000
        draws = sampled(V, [text] * n, np.arange(n, dtype=np.uint64) * np.uint64(7919) + np.uint64(1), 3)
        first = Counter()
        weights = []
        for rows in draws:
            assert len({tuple(r[0]) for r in rows}) == len(rows) == min(3, len(every))
            assert all(math.isclose(r[1], every[tuple(r[0])], abs_tol=1e-4) and V.decode(r[0]) == text for r in rows)
            assert [r[2] for r in rows] == sorted((r[2] for r in rows), reverse=True)
            first[tuple(rows[0][0])] += 1
            weights.append(sum(math.exp(r[1] - r[3]) for r in rows))
        for ids, x in every.items():  # the first of each row is a plain sample
            p = math.exp(x)
            assert abs(first[ids] / n - p) < 5 * math.sqrt(p * (1 - p) / n) + 1e-3, (text, ids)
        assert abs(np.mean(weights) - 1) < 5 * np.std(weights) / math.sqrt(n) + 1e-6  # inclusion scores are without bias


def test_second_sample_without_replacement():
    every = all_segmentations("hat")
    n = 4000
    second = Counter(tuple(r[1][0]) for r in sampled(V, ["hat"] * n, np.arange(n, dtype=np.uint64) * np.uint64(31) + np.uint64(9), 2))
    for ids, x in every.items():
        p = sum(math.exp(y) * math.exp(x) / (1 - math.exp(y)) for other, y in every.items() if other != ids)
        assert abs(second[ids] / n - p) < 5 * math.sqrt(p * (1 - p) / n) + 1e-3


def test_rows_do_not_hang_on_others(spark, sf):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").limit(40).collect()]
    docs += [(-1, None), (-2, ""), (None, "x y"), (None, "x y"), (-3, "two  spaces and ▁ "), (-4, "é" * 3000), (-5, "a " * 60000)]
    frame = spark.createDataFrame([(d, t, 1, "k") for d, t in docs], "doc_id long, text string, sample int, ids string")
    got = sample_segmentations(frame, PATH).collect()
    assert all(r.decoded and r.log_inclusion <= 0 for r in got)
    count = Counter(r.doc_id for r in got)
    assert count[-1] == count[-2] == 1 and count[None] == 4 and all(count[d] == 2 for d, t in docs if d is not None and t)
    again = sample_segmentations(frame.repartition(7).filter("doc_id < 20"), PATH).collect()
    few = {(r.doc_id, r.sample): (r.ids, round(r.perturbed, 9)) for r in got}
    assert again and all(few[r.doc_id, r.sample] == (r.ids, round(r.perturbed, 9)) for r in again)
    assert sample_segmentations(frame.limit(0), PATH).count() == 0


def test_plain_encoding_and_decoding(spark, sf):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=PATH)
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()] + [(-1, None), (-2, ""), (None, "né 日 \n ▁x"), (None, "x" * 5000)]
    frame = spark.createDataFrame([(d, t, 1) for d, t in docs], "doc_id long, text string, ids int")
    pieces = encode_documents(frame, PATH).cache()
    assert Counter((r.doc_id, tuple(r.ids)) for r in pieces.collect()) == Counter((d, tuple(model.encode(t or ""))) for d, t in docs)
    assert Counter((r.doc_id, r.text) for r in decode_documents(pieces, PATH).collect()) == Counter((d, model.decode(model.encode(t or ""))) for d, t in docs)
    sampled_ids = sample_segmentations(frame, PATH).select("doc_id", "ids", "sample")
    back = Counter((r.doc_id, r.text) for r in decode_documents(sampled_ids.filter("sample = 0"), PATH).collect())
    assert back == Counter((d, t or "") for d, t in docs)
    assert encode_documents(frame.limit(0), PATH).count() == 0 and decode_documents(spark.createDataFrame([(1, None), (2, [None, 5])], "doc_id long, ids array<int>"), PATH).count() == 2


def test_a_step_takes_little_memory():
    rng = np.random.default_rng(5)
    words = [p.strip("▁") for p in V.pieces if p.startswith("▁") and len(p) > 3]
    texts = strings(pa.array([" ".join(rng.choice(words, 330)) for _ in range(1800)]))
    tracemalloc.start()
    try:
        for first, end, _, _ in steps(texts, gumbel_pieces.STEP):
            sampled(V, texts[first:end].to_pylist(), np.arange(first, end, dtype=np.uint64), 2)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 160 << 20, peak >> 20
