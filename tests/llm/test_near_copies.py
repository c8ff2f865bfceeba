import random
import re
import time

import numpy as np
import pyarrow as pa

import corpus_pipeline as p
from tallyloom.llm.near_copies import LIMIT, WIDTH, near_copy_groups, shingle_hashes, table_keys, table_masks, wide_fingerprints
from tallyloom.llm.simhash_groups import GrayIndex

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def shingles(text, w=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(words[i : i + w]) for i in range(len(words) - w + 1)} or ({tuple(words)} if words else set())


def jaccard(a, b):
    return len(a & b) / len(a | b) if a or b else 1.0


def brute(rows):
    """The rows that stay: of each component of pairs with a similarity of 0.8 or more, that with the smallest doc_id."""
    sets = [shingles(t) for _, t in rows]
    group = list(range(len(rows)))

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                group[max(a, b)] = min(a, b)
    out = {}
    for i, (d, t) in enumerate(rows):
        out.setdefault(find(i), []).append((d is None, d or 0, t or ""))
    return [{r[:2] for r in x if r[:2] == min(x)[:2]} for x in out.values()]


def stays(spark, rows):
    frame = spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in rows], SCHEMA)
    got = [(r.doc_id is None, r.doc_id or 0) for r in p.near_duplicates(spark, frame, "").collect()]
    want = brute(rows)
    assert len(got) == len(want), (len(got), len(want))
    assert sorted(got) == sorted(min(x) for x in want)
    return got


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**9)}"
    return " ".join(words)


def test_stage_against_jaccard(spark):
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(500)]
    rows = []
    for _ in range(60):  # similarities from 0.3 to 1, many of them near 0.8
        words = rng.choices(vocabulary, k=rng.randrange(60, 300))
        rows += [" ".join(words), edited(rng, words, max(1, round(len(words) * rng.uniform(0.005, 0.06))))]
    hub = rng.choices(vocabulary, k=150)  # copies of one text that are often less like each other than like it
    rows += [edited(rng, hub, rng.randrange(1, 7)) for _ in range(60)] + [" ".join(hub)] * 3
    rows = list(enumerate(rows))
    rng.shuffle(rows)
    rows += [(9000, None), (9001, ""), (9002, " \t"), (9003, "a b"), (9004, "A  b\n"), (9005, "a b c"), (None, "one of its own kind with no id"), (None, "ONE of its own kind with no id"), (None, "x"), (7, "not what the other row of this id says"), (7, "nor is this like it at all, see"), (None, rows[0][1])]
    between = [jaccard(shingles(a), shingles(b)) for _, a in rows[:120] for _, b in rows[:120]]
    assert sum(0.8 <= x < 0.9 for x in between) >= 10
    stays(spark, rows)


def test_documents(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = stays(spark, rows)
    assert (False, 1) in got and (False, 177) not in got  # similarity 0.83, more than 4 bits apart


def test_candidates_are_complete():
    """Nearly all of 750 pairs with a similarity of just about 0.8 share a table's value and are within the limit."""
    rng = random.Random(9)
    pairs = []
    for _ in range(750):
        words = [str(rng.randrange(10**6)) for _ in range(210)]
        other = words[:187] + [str(rng.randrange(10**6)) for _ in range(23)]
        assert 0.79 < jaccard(shingles(" ".join(words)), shingles(" ".join(other))) < 0.81
        pairs += [" ".join(words), " ".join(other)]
    fp = np.concatenate([wide_fingerprints(h, n) for h, n in shingle_hashes(pa.array(pairs, pa.large_string()))])
    near = np.bitwise_count(fp[::2] ^ fp[1::2]).sum(1) <= LIMIT
    for texts in (1500, 1 << 26):
        keys = table_keys(fp, table_masks(texts))
        shared = (keys[::2] == keys[1::2]).any(1)
        assert keys.shape[0] == 1500 and (shared & near).mean() > 0.97, (shared.mean(), near.mean())
        assert np.mean(keys[::2] == keys[2 * np.arange(-1, 749)]) < 0.001
    assert len(table_masks(1 << 26)) > len(table_masks(1500))


def test_nothing_alike(spark):
    rows = [(1, "one text"), (2, "quite another one"), (3, None)]
    assert len(stays(spark, rows)) == 3


def test_empty(spark):
    assert p.near_duplicates(spark, spark.createDataFrame([], SCHEMA), "").count() == 0


def test_index_with_groups():
    """All pairs of different groups within the limit, and nodes of the query's own group are left out."""
    rng = np.random.Generator(np.random.PCG64(5))
    base = rng.integers(0, 2**63, WIDTH, dtype=np.uint64)
    fp = np.tile(base, (3000, 1))
    fp[np.arange(3000), rng.integers(0, WIDTH, 3000)] ^= np.uint64(1) << rng.integers(0, 64, 3000).astype(np.uint64)
    key, group = np.zeros(3000, np.uint64), np.zeros(3000, np.int64)
    strays = rng.choice(3000, 12, replace=False)
    group[strays] = np.arange(1, 13) // 2
    index = GrayIndex(key, fp, 2, group)
    got = {tuple(sorted(p)) for x, y in index.pairs() for p in zip(x.tolist(), y.tolist(), strict=True)}
    want = set()
    for i in strays.tolist():
        near = np.flatnonzero((np.bitwise_count(fp ^ fp[i]).sum(1) <= 2) & (group != group[i]))
        want |= {tuple(sorted((i, j))) for j in near.tolist()}
    assert got == want and len(want) > 11 * 2900  # the first of the twelve is in the large group
    assert index.looked < 30 * 3000, index.looked
    alone = GrayIndex(key, fp, 2, np.zeros(3000, np.int64))
    assert list(alone.pairs()) == [] and alone.looked == 0


def test_very_many_near_copies(spark):
    """20,000 different copies of one text: one group, found without looking at their pairs."""
    rng = random.Random(6)
    words = [f"w{rng.randrange(10**6)}" for _ in range(120)]
    texts = []
    for i in range(20000):
        some = list(words)
        some[rng.randrange(120)] = f"n{i}"
        texts.append(" ".join(some))
    frame = spark.createDataFrame(list(enumerate([*texts, "quite another text"])), "doc_id long, text string").repartition(8)
    at = time.time()
    groups = near_copy_groups(frame).groupBy("group").count().collect()
    assert [r["count"] for r in groups] == [20000]
    assert time.time() - at < 240


def test_tables_are_taken_in_shares(spark):
    """No entries are kept, the shares of the tables make up all of them, and a pair that only one share finds is a link."""
    import os

    from tallyloom.llm.near_copies import PASSES, in_passes, table_masks
    from tallyloom.llm.shared import shared_dir

    masks, seen = table_masks(300), []

    def found(part, shards):
        seen.append(part)
        return spark.createDataFrame([(len(seen), shards)], "share int, shards int")

    rows = in_passes(masks, 300, found, "test-share").collect()
    assert len(seen) == PASSES > 1 and (np.concatenate(seen) == masks).all()
    assert sorted(r.share for r in rows) == list(range(1, PASSES + 1))
    words = [f"w{i}" for i in range(400)]
    texts = [" ".join(words[i : i + 80]) for i in range(0, 320, 80)] + [" ".join([*words[i : i + 79], "other"]) for i in range(0, 320, 80)]
    folder = shared_dir(spark).removeprefix("file:") + "/kept"
    before = set(os.listdir(folder))
    groups = near_copy_groups(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert len(groups) == 8 and len({r.group for r in groups}) == 4
    assert not [x for x in set(os.listdir(folder)) - before if x.startswith("near-shards")]


def test_texts_are_shuffled_once(spark):
    """Of the exchanges before the result one bears texts; equal rows, null ids and rows of equal id and other columns stay one."""
    rows = [(1, "a b c d e f", "en", "s", 11), (1, "a b c d e f", "en", "s", 11), (1, "a b c d e f", "de", "s", 11), (None, "x", "en", "s", 1), (None, "x", "en", "s", 1), (2, "y", None, "s", 1)]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        done = p.near_duplicates(spark, spark.createDataFrame(rows, SCHEMA), "")
        plan = done._jdf.queryExecution().executedPlan().toString()
        got = done.collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("Exchange hashpartitioning") == 2, plan  # the documents, and the rows that stay
    assert sorted((r.doc_id or 0, r.text) for r in got) == [(0, "x"), (1, "a b c d e f"), (2, "y")]
