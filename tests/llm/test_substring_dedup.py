import random
import re
from collections import Counter

import numpy as np

from tallyloom.llm.shared import in_blocks
from tallyloom.llm.substring_dedup import remove_repeats, sliding

SCHEMA = "doc_id long, text string, n_words long, block long"


def brute(rows, w=35):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    seen = Counter(tuple(x[i : i + w]) for x in words for i in range(len(x) - w + 1))
    out = []
    for (d, _), x in zip(rows, words, strict=True):
        gone = set()
        for i in range(len(x) - w + 1):
            if seen[tuple(x[i : i + w])] > 1:
                gone.update(range(i, i + w))
        out.append((d, len(x), len(gone), " ".join(v for i, v in enumerate(x) if i not in gone)))
    return sorted(out, key=str)


def run(spark, rows, **more):
    frame = spark.createDataFrame([(d, t, 7, 8) for d, t in rows], SCHEMA)
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in remove_repeats(frame, **more).collect()), key=str)


def test_against_brute_force(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got, want = run(spark, rows, block_bytes=100_000), brute(rows)
    assert sum(r[2] for r in want) > 0
    assert got == want


def test_edges(spark):
    rng = random.Random(3)
    long = " ".join(rng.choice("abcdefgh") + str(rng.randrange(60)) for _ in range(9000))
    part = " ".join(long.split()[100:135])
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "x " * 34), (5, "y " * 36), (6, long), (7, "é " + part + "\n z"), (None, part), (None, part), (8, " ".join(long.split()[500:534])), (9, "ab " * 20 + "c"), (10, "p q r " * 30)]
    assert run(spark, rows) == brute(rows)
    for length in (1, 2, 3, 7):
        assert run(spark, rows, length=length) == brute(rows, length), length
    frame = spark.createDataFrame([(1, "a b", 7, 8)], SCHEMA)
    assert remove_repeats(frame, ["doc_id", "text"]).collect()[0].text == "a b"


def test_empty(spark):
    assert run(spark, []) == []


def test_sliding():
    x = np.random.default_rng(1).integers(0, 99, 50).astype(np.uint64)
    for w in range(1, 30):
        assert (sliding(np.minimum, x, w) == [x[i : i + w].min() for i in range(51 - w)]).all()


def test_clashing_columns_and_repeated_rows(spark):
    text = " ".join(f"w{i}" for i in range(50))
    frame = spark.createDataFrame([(i, f"{text} {i}", 7, 8, "b") for i in range(3)] + [(9, "same words " * 30, 1, 1, "b")] * 3000, "doc_id long, text string, n_words int, n_removed int, block string")
    got = remove_repeats(frame, ["doc_id", "block", "n_words", "n_removed"], block_bytes=20_000)
    assert got.columns == ["doc_id", "block", "n_words", "n_removed", "kept_text"] and {r.block for r in got.collect()} == {"b"}
    assert sorted({(r.doc_id, r.n_words, r.n_removed) for r in got.collect()}) == [(0, 51, 50), (1, 51, 50), (2, 51, 50), (9, 60, 60)] and got.count() == 3003
    blocked, blocks, _ = in_blocks(frame, ["doc_id", "text"], 20_000)
    assert blocks > 40 and max(r["count"] for r in blocked.groupBy("block").count().collect()) < 400
