import re

import numpy as np
import xxhash

from tallyloom.llm.simhash_groups import fingerprint_links, gray_rank, simhash_groups

SCHEMA = "doc_id long, text string, fp long"


def fingerprint(text, w=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(words[i : i + w]) for i in range(len(words) - w + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows, limit=4):
    fps = [fingerprint(t) for _, t in rows]
    group = list(range(len(rows)))

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= limit:
                a, b = find(i), find(j)
                group[max(a, b)] = min(a, b)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return sorted(((d, f"{fps[i]:016x}", least.get(find(i))) for i, (d, _) in enumerate(rows)), key=str)


def test_against_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    rows += [(9001, None), (9002, ""), (9003, "a b"), (9004, "A  b\n"), (None, "x y z w v"), (rows[0][0], rows[0][1]), (9005, "w" * 70000 + " é b c d e"), (9006, " \t")]
    frame = spark.createDataFrame([(d, t, 1) for d, t in rows], SCHEMA)
    got = sorted(((r.doc_id, r.fingerprint, r.component_id) for r in simhash_groups(frame).collect()), key=str)
    assert got == brute(rows)


def test_empty(spark):
    assert simhash_groups(spark.createDataFrame([], SCHEMA)).count() == 0


def test_links_of_dense_fingerprints(spark):
    """Chains and clusters, also where values are split again."""
    rng = np.random.default_rng(5)
    seeds = rng.integers(0, 2**63, 12, dtype=np.uint64)
    fps = set()
    for s in seeds:
        x = int(s)
        for _ in range(60):
            for b in rng.choice(64, rng.integers(1, 6), replace=False):
                x ^= 1 << int(b)
            fps.add(x)
    fps = sorted(fps)
    group = {x: x for x in fps}

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    for i, x in enumerate(fps):
        for y in fps[:i]:
            if (x ^ y).bit_count() <= 4:
                group[find(x)] = find(y)
    want = {frozenset(y for y in fps if find(y) == find(x)) for x in fps}
    frame = spark.createDataFrame([(int(np.uint64(x).astype(np.int64)),) for x in fps], "fp long")
    for split in (3000, 20):
        group = {x: x for x in fps}
        for r in fingerprint_links(frame, split_from=split).collect():
            a, b = r.a % 2**64, r.b % 2**64
            group[find(a)] = find(b)
        assert {frozenset(y for y in fps if find(y) == find(x)) for x in fps} == want


def test_gray_rank():
    rank = np.arange(5000, dtype=np.uint64)
    assert (gray_rank(rank ^ (rank >> np.uint64(1))) == rank).all()
