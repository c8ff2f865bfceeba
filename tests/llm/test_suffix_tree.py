import math
import random
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tallyloom.llm.suffix_tree import STATE, Rules, Walk, different, score_documents, told

SCHEMA = "doc_id long, text string, block long, held boolean"


def tokens(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", low), None]


def brute(rows, depth, least, prior, divergence):
    held = [d is not None and zlib.crc32(str(d).encode()) % 7 == 2 for d, _ in rows]
    all_tokens = [tokens(t) for _, t in rows]
    counts = [defaultdict(Counter) for _ in range(depth + 1)]
    for t, h in zip(all_tokens, held, strict=True):
        for i, w in enumerate([] if h else t):
            for k in range(min(depth, i) + 1):
                counts[k][tuple(t[i - k : i])][w] += 1
    c0 = counts[0][()]
    n, v = sum(c0.values()), len(c0)
    tree = {}

    def p(context, w):
        if not context:
            return (c0[w] + 1) / (n + v + 1)
        below = p(context[1:], w)
        if context not in tree:
            return below
        return (tree[context][w] + prior * below) / (sum(tree[context].values()) + prior)

    for k in range(1, depth + 1):
        new = {}
        for context, nexts in counts[k].items():
            total = sum(nexts.values())
            if total >= least:
                gain = sum(c * math.log10((c - 1 + prior * p(context[1:], w)) / (total - 1 + prior) / p(context[1:], w)) for w, c in nexts.items())
                if gain > divergence * total:
                    new[context] = nexts
        tree |= new
    out = []
    for (d, _), h, t in zip(rows, held, all_tokens, strict=True):
        contexts = [max((tuple(t[i - k : i]) for k in range(min(depth, i) + 1) if k == 0 or tuple(t[i - k : i]) in tree), key=len) for i in range(len(t))]
        base = sum(math.log10((c0[w] + 1) / (n + v + 1)) for w in t)
        out.append((d, h, len(t), sum(c0[w] > 0 for w in t), n, base, sum(math.log10(p(tuple(t[max(0, i - depth) : i]), w)) for i, w in enumerate(t)), sum(map(bool, contexts))))
    return out, tree


def same(spark, rows, depth=3, least=50, prior=100.0, divergence=0.01, **more):
    frame = spark.createDataFrame([(d, t, 1, True) for d, t in rows], SCHEMA)
    got = score_documents(frame, depth, least, prior, divergence, **more).collect()
    want, tree = brute(rows, depth, least, prior, divergence)
    key = lambda r: (str(r[0]), r[2], round(r[5], 3))
    for a, b in zip(sorted(map(tuple, got), key=key), sorted(want, key=key), strict=True):
        assert a[:5] == b[:5] and a[7] == b[7]
        assert math.isclose(a[5], b[5], rel_tol=1e-9) and math.isclose(a[6], b[6], rel_tol=1e-9), (a, b)
    return got, tree


def test_against_definition(spark):
    rng = random.Random(6)
    follow = {w: rng.sample("abcdefgh", 2) for w in "abcdefgh"}
    rows = []
    for i in range(120):
        t = [rng.choice("abcdefgh")]
        for _ in range(rng.randrange(1, 60)):
            t.append(rng.choice(follow.get(t[-1], ["a", "b"])) if rng.random() < 0.7 else (t[-2] if len(t) > 1 and rng.random() < 0.5 else rng.choice("abcdefghijklm")))
        rows.append((i, " ".join(t)))
    rows += [(500, None), (501, ""), (None, "a b\tc"), (None, "A  B c"), (502, "new words é É"), (3, "a b"), (503, "a b c d " * 3000)]
    got, tree = same(spark, rows, 4, 12, 5.0, 0.01, block_bytes=1500)
    assert {len(c) for c in tree} == {1, 2, 3, 4}
    # contexts dealt over several shards
    same(spark, rows, 4, 12, 5.0, 0.01, block_bytes=1500, split=40)
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_documents(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    _, tree = same(spark, rows, block_bytes=200_000)
    assert {len(c) for c in tree} == {1, 2, 3}


def test_empty(spark):
    assert score_documents(spark.createDataFrame([], SCHEMA)).count() == 0
    held = [(i, "a b") for i in range(60) if zlib.crc32(str(i).encode()) % 7 == 2]
    same(spark, held)


def test_deeper_levels_start_from_states():
    """What a block asks at the third level is the same from its texts as from the state it sent at the second."""
    rng = random.Random(8)
    words = ["a", "b", "c", "d"]
    texts = [" ".join(rng.choices(words, k=rng.randrange(0, 40))) for _ in range(60)] + [None, "a"]
    part = pa.table({"text": pa.array(texts), "held": pa.array([i % 7 == 2 for i in range(len(texts))])})
    rules = Rules(4, 5, 10.0, 0.0, 1 << 17, 900, 5)
    walk, depth = Walk.of_texts(part, rules), 4
    state = None
    for level in range(depth + 1):
        from_texts = told(walk, 7, depth)
        if state is not None:
            other = Walk.of_state(state, level - 1, rules)
            other.take(answers)
            assert told(other, 7, depth).equals(from_texts)
        shards = from_texts.filter(pc.not_equal(from_texts.column("shard"), STATE))
        state = from_texts.filter(pc.equal(from_texts.column("shard"), STATE))
        assert len(state) == (2 <= level < depth)
        state = state if len(state) else None
        said = [np.frombuffer(x, np.uint32).astype(np.int64) * (2 if level else 1) + bool(level) for x in shards.column("counts").to_pylist()]
        answers = pa.table([shards.column("shard"), pa.array([level] * len(said), pa.int32()), pa.array([x.tobytes() for x in said], pa.binary())], names=["shard", "level", "counts"])
        walk.take(answers)


def test_different():
    key = np.random.default_rng(2).integers(0, 40, 500, dtype=np.uint64) << np.uint64(58)
    found, place, number = different(key)
    assert (found == np.unique(key)).all() and (key[place] == found).all() and (found[number] == key).all()
    assert [len(x) for x in different(key[:0])] == [0, 0, 0]


def test_values_of_equal_leading_bits_are_told_apart():
    key = np.random.default_rng(3).integers(0, 9, 3000, dtype=np.uint64) + (np.random.default_rng(4).integers(0, 5, 3000, dtype=np.uint64) << np.uint64(60))
    found, place, number = different(key)
    assert (found == np.unique(key)).all() and (key[place] == found).all() and (found[number] == key).all()


def test_asking_takes_little_memory():
    rng = np.random.default_rng(5)
    texts = [" ".join(f"w{x}" for x in rng.zipf(1.3, 500) % 50_000) for _ in range(1000)]
    part = pa.table({"text": pa.array(texts), "held": pa.array([False] * len(texts))})
    walk = Walk.of_texts(part, Rules(4, 50, 100.0, 0.01, 1 << 17, 500_000, 50_000))
    walk.level, walk.at, walk.total = 1, walk.at[1:], walk.total[1:]
    tracemalloc.start()
    try:
        asked = walk.ask()
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert len(asked.key) > 100_000
    assert peak < 55 * len(walk.at), peak / len(walk.at)
