import hashlib
import random

import numpy as np

from tallyloom.llm.edit_fingerprint import BITS, LEAST, MULTIPLIER, NONE, band_keys, embedded, fingerprint_documents, grouped_fingerprints, likeness, near_groups, sampled_steps, unwritten, with_next, written


def walk(text):
    """The embedding, character by character."""
    out, i, j = [], 0, 0
    while i < len(text):
        c = ((ord(text[i]) + 1) * 0x85EBCA77) % 2**32
        c ^= c >> 13
        out.append((c * 0xC2B2AE3D % 2**32) >> 28)
        i += ((c ^ int(BITS[j % 65536])) * MULTIPLIER % 2**32) >> 31
        j += 1
    return out


def test_embedding_against_plain_walks():
    rng = random.Random(1)
    texts = ["", "a", "é" * 70, "ab" * 40] + ["".join(rng.choices("abcdeé ", k=rng.randrange(1, 900))) for _ in range(60)] + ["".join(rng.choices("xyz", k=30000))]
    samples = embedded(texts)
    steps = sampled_steps(samples.shape[1] // 32)
    for text, row in zip(texts, samples, strict=True):
        w = walk(text)
        assert row.tolist() == [w[s] if s < len(w) else NONE for s in steps]
    assert written(samples)[0] == "" and written(embedded(["ab" * 40]))[0] == written(samples)[3]


def test_likeness_follows_edits():
    rng = random.Random(2)
    rows = []
    for _ in range(40):
        base = "".join(rng.choices("abcdefghij ", k=4000))
        some = list(base)
        for _ in range(2):
            some[rng.randrange(len(some))] = rng.choice("xyz")
            some.insert(rng.randrange(len(some)), "q")
        half = base[:2000] + "".join(rng.choices("abcdefghij ", k=2000))
        e = embedded([base, base, "".join(some), half, "".join(rng.choices("abcdefghij ", k=4000))])
        rows.append([float(likeness(e[:1], e[i : i + 1])[0]) for i in range(1, 5)])
    same, near, mid, far = np.mean(rows, axis=0)
    assert same == 1 and near > mid + 0.05 and 0.45 < mid < 0.65 and far < 0.25, (near, mid, far)


def expected(rows):
    rows = sorted(((d, t or "") for d, t in rows), key=lambda r: r[1])
    rows = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = []
    for i, (d, t) in enumerate(rows):
        n = rows[(i + 1) % len(rows)][1]
        h = len(t) // 2
        edited = t[: len(t) - h] + n[:h]
        e = embedded([t, edited, n])
        out.append((d, len(t), hashlib.sha256(edited.encode()).hexdigest(), written(e)[0], written(e)[1], round(float(likeness(e[:1], e[1:2])[0]), 9), round(float(likeness(e[:1], e[2:3])[0]), 9)))
    return sorted(out, key=str)


def test_documents(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    rows += [(90000, None), (90001, ""), (None, "no id"), (90003, "twice"), (90003, "twice"), (90004, "é" * 50001), (-7, "x")]
    frame = spark.createDataFrame([(d, t, 1, True) for d, t in rows], "doc_id long, text string, part int, halo boolean")
    got = sorted((tuple(r)[:5] + (round(r.near_edited, 9), round(r.near_next, 9)) for r in fingerprint_documents(frame, part_bytes=60_000).collect()), key=str)
    assert got == expected(rows)
    one = fingerprint_documents(frame.filter("doc_id = -7")).collect()
    assert len(one) == 1 and one[0].near_next == 1
    assert fingerprint_documents(frame.limit(0)).count() == 0
    assert np.mean([r[5] for r in got]) > np.mean([r[6] for r in got])


def test_parts_of_skewed_ids(spark):
    """Ids far apart, equal ids and null ids are split like others."""
    words = [f"text number {i} " * 9 for i in range(4000)]
    for ids in ([*range(1999), 10**15] * 2, [None] * 4000, [5] * 4000, [-(2**63), *range(3999)]):
        frame = spark.createDataFrame(list(zip(ids, words, strict=True)), "doc_id long, text string")
        parts = with_next(frame, 8000).filter("not halo").groupBy("part").count().collect()
        assert sum(r["count"] for r in parts) == 4000 and len(parts) > 40 and max(r["count"] for r in parts) < 400, len(parts)


def test_written_and_back():
    texts = ["", "a", "ab" * 40, "".join(map(chr, range(97, 120))) * 90]
    samples = embedded(texts)
    back = unwritten(written(samples))
    assert (back == samples[:, : back.shape[1]]).all() and (samples[:, back.shape[1] :] == NONE).all()


def test_near_groups_against_all_pairs(spark, sf):
    rng = random.Random(8)
    texts = [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    for t in texts[:120]:  # copies with a few edits each, from nearly equal to well under the limit
        some = list(t)
        for _ in range(rng.randrange(1, 6)):
            some[rng.randrange(len(some))] = rng.choice("xyz")
        texts.append("".join(some))
    hub = "".join(rng.choices("abcdefghij ", k=3000))
    texts += [hub[:i] + "q" + hub[i:] for i in range(0, 3000, 60)] + ["", None, "x", "x"]
    prints = written(embedded([t or "" for t in texts]))
    different = sorted(set(prints))
    samples = unwritten(different)
    pairs = {(i, j) for i in range(len(different)) for j in np.flatnonzero(likeness(samples[:i], np.broadcast_to(samples[i], (i, samples.shape[1]))) >= LEAST).tolist()} if len(different) > 1 else set()
    group = list(range(len(different)))

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    for i, j in pairs:
        group[find(i)] = find(j)
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.group_id for r in grouped_fingerprints(frame).collect()}
    assert len(got) == len(texts)
    first = {p: min(i for i, x in enumerate(prints) if x == p) for p in different}
    of = {p: got[first[p]] for p in different}
    assert all(got[i] == of[p] for i, p in enumerate(prints))
    found = sum(of[different[i]] == of[different[j]] for i, j in pairs)
    assert len(pairs) > 100 and found / len(pairs) >= 0.97, (found, len(pairs))
    for k in range(len(different)):  # nothing is joined that links don't join
        assert find(different.index(prints[of[different[k]]])) == find(k)
    assert near_groups(spark.createDataFrame([], "node long, fingerprint string")).count() == 0


def test_bands_of_short_texts():
    """Every near pair of short texts shares a key, and no key is shared by many of them."""
    rng = random.Random(11)
    texts = {"".join(rng.choices("abcdefghijklmnopqrstuvwxyz ", k=8)) for _ in range(20000)}
    different = sorted(set(written(embedded(sorted(texts)))))
    row, key = band_keys(unwritten(different))
    sizes = np.unique(key, return_counts=True)[1]
    assert sizes.max() < len(different) // 100 and len(row) < 12 * len(different), (sizes.max(), len(row), len(different))
    few = sorted({"".join(rng.choices("abc", k=rng.randrange(1, 22))) for _ in range(400)})
    few += [t[:i] + "d" + t[i + 1 :] for t in few[::4] for i in range(0, len(t), 3)]
    samples = unwritten(sorted(set(written(embedded(few)))))
    counts = (samples != NONE).sum(1)
    row, key = band_keys(samples)
    keys_of = [set(key[row == i].tolist()) for i in range(len(samples))]
    found = 0
    for i in range(len(samples)):
        for j in np.flatnonzero(likeness(samples[:i], np.broadcast_to(samples[i], (i, samples.shape[1]))) >= LEAST).tolist():
            if max(counts[i], counts[j]) < 32:
                found += 1
                assert keys_of[i] & keys_of[j], (i, j)
    assert found > 30, found
