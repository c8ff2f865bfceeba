import base64
import hashlib
import random

import public_tokenizers
import pytest
import regex

from tallyloom.llm.byte_bpe import SAFE, Ranks, decode_documents, encode_documents
from tallyloom.llm.queries import op12_byte_bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
RANKS = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}


def merged(part):
    """Ids of one match: the pair of least rank is joined first, the leftmost of equals."""
    units = [bytes([b]) for b in part]
    while True:
        ranked = [(RANKS[a + b], i) for i, (a, b) in enumerate(zip(units, units[1:])) if a + b in RANKS]
        if not ranked:
            return [RANKS[u] for u in units]
        i = min(ranked)[1]
        units[i : i + 2] = [units[i] + units[i + 1]]


def plain_ids(text):
    return [x for m in regex.findall(public_tokenizers.PATTERN, text) for x in merged(m.encode())]


ODD = ["", " ", "  ", "\n\n x", "a  b", "it's 's 'S '' 've'llx", "<|endoftext|>", "naïve Ünï 12345 1a2b", "\x1c\x1d a\x85b\xa0c　d", "日本語のテキスト。とても", "😀👩‍👩‍👧 x", "\x00\x01", "é", "tab\t\tend\t", "a" * 300, " " * 300 + "x"]


def test_query_against_plain_merges(spark, sf):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = op12_byte_bpe(spark, sf).collect()
    assert len(got) == len(docs)
    for r in got:
        assert r.decoded_sha256 == hashlib.sha256(docs[r.doc_id].encode()).hexdigest()
        if len(docs[r.doc_id]) < 3000:
            ids = plain_ids(docs[r.doc_id])
            assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


@pytest.mark.parametrize("text", ODD)
def test_odd_texts(text):
    assert Ranks(PATH, public_tokenizers.PATTERN, SAFE).ids(text).tolist() == plain_ids(text)


def test_cuts_change_nothing():
    ranks, rng = Ranks(PATH, public_tokenizers.PATTERN, SAFE), random.Random(3)
    parts = [" ", "  ", "\n", "\t", "　", "\x85", "\x1c", "a", "word", "It's", "'", "'s", "12", "é", "。", "語", "!", "😀", "́"]
    for _ in range(1500):
        text = "".join(rng.choices(parts, k=rng.randrange(1, 40)))
        cut = list(ranks.pieces(text, 2))
        assert "".join(cut) == text
        assert ranks.ids(text, 2).tolist() == ranks.encoding.encode_ordinary(text), repr(text)


def test_edges(spark):
    long = ("many words, " * 30000) + "x" * 200000 + " " * 100000 + "語" * 50000
    rows = [(1, None, 5), (None, "a b", 5), (2, "", 5), (3, long, 5), (4, "same", 5), (4, "same", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    encoded = encode_documents(docs, PATH)
    assert encoded.columns == ["doc_id", "ids"]
    got = sorted(((r.doc_id, bytes(r.decoded).decode()) for r in decode_documents(encoded, PATH).collect()), key=str)
    assert got == sorted(((a, b or "") for a, b, _ in rows), key=str)
    assert encode_documents(docs.limit(0), PATH).count() == 0
    broken = spark.createDataFrame([(1, [RANKS[b"\xff"], None, 99999999]), (2, None)], "doc_id long, ids array<int>")
    assert {r.doc_id: bytes(r.decoded) for r in decode_documents(broken, PATH).collect()} == {1: b"\xff", 2: b""}
