import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from tallyloom.llm.kneser_ney import ANY, ORDER, Lookup, classify_quality, perplexities, trained_models, trusted_sample, with_thresholds

DOCS = "doc_id long, text string, lang string, perplexity string"
LABELS = "doc_id long, quality int, toxic int"


def symbols(text):
    out, before = [2] * (ORDER - 1), None
    for w in re.findall(r"[^\x20\x09-\x0D]+", text or ""):
        if w == before:
            out[-1] = 1
        else:
            out += w.encode()
            before = w
            out.append(32)
            continue
        out.append(32)
    return [*out, 3]


class Plain:
    """The model from its definition, with dictionaries."""

    def __init__(self, texts):
        c = {ORDER: Counter()}
        for t in texts:
            s = symbols(t)
            c[ORDER].update(tuple(s[i : i + ORDER]) for i in range(len(s) - ORDER + 1))
        for k in range(ORDER - 1, 0, -1):
            c[k] = Counter(g[1:] for g in c[k + 1])
        self.c, self.d, self.context = c, {}, {}
        for k in c:
            t = Counter(min(n, 5) for n in c[k].values())
            y = t[1] / (t[1] + 2 * t[2]) if t[1] + 2 * t[2] else 0.5
            self.d[k] = [max(0.05, min(i - 0.05, i - (i + 1) * y * t[i + 1] / t[i])) if t[i] else 0.5 for i in (1, 2, 3)]
            sums = defaultdict(lambda: [0, 0.0])
            for g, n in c[k].items():
                sums[g[:-1]][0] += n
                sums[g[:-1]][1] += self.d[k][min(n, 3) - 1]
            self.context[k] = sums

    def p(self, g):
        k = len(g)
        below = self.p(g[1:]) if k > 1 else 1 / 256
        if g[:-1] not in self.context[k]:
            return below
        total, taken = self.context[k][g[:-1]]
        n = self.c[k].get(g, 0)
        return ((n - self.d[k][min(n, 3) - 1]) if n else 0) / total + taken / total * below

    def perplexity(self, text):
        s = symbols(text)
        logs = [math.log10(self.p(tuple(s[i : i + ORDER]))) for i in range(len(s) - ORDER + 1)]
        return 10 ** -(sum(logs) / len(logs))


def test_model_against_definition(spark, sf):
    docs = [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").limit(40).collect()]
    train, rest = docs[:25], [*docs[25:], "", None, " \n", "a a a a b b", "x" * 3000, "ÿ"]
    models = trained_models(spark.createDataFrame([("en", t) for t in train], "lang string, text string"))
    plain = Plain(train)
    frame = spark.createDataFrame([(i, t, lang, "") for i, t in enumerate(rest) for lang in ("en", "other")], DOCS)
    got = perplexities(frame, models, block_bytes=20_000).collect()  # several blocks
    assert len(got) == 2 * len(rest)
    for r in got:
        assert math.isclose(r.perplexity, plain.perplexity(rest[r.doc_id]), rel_tol=2e-3), rest[r.doc_id]
    context = tuple(symbols(train[0])[9 : 9 + ORDER - 1])
    assert math.isclose(sum(plain.p((*context, w)) for w in range(256)), 1, rel_tol=1e-9)


def test_held_out_accuracy(spark):
    """On labelled rows that aren't part of the sample."""
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    got = {r.doc_id: r.keep for r in classify_quality(spark.read.parquet(f"{sf}/documents.parquet"), labels, train_rows=40).collect()}
    truth = {r.doc_id: r.quality for r in labels.filter('toxic = 0').collect()}
    junk = [got[d] for d, q in truth.items() if q == 0]
    clean = [got[d] for d, q in truth.items() if q == 1]
    assert np.mean(junk) < 0.1 and np.mean(clean) > 0.97


def test_edges(spark):
    rng = random.Random(1)
    words = ["".join(rng.choices("abcde", k=rng.randrange(2, 6))) for _ in range(60)]
    docs = [(i, " ".join(rng.choices(words, k=80)), "en", "") for i in range(60)] + [(100, None, "en", ""), (101, "", None, ""), (None, "abc", "en", ""), (102, "### $$$ %%%", "en", ""), (102, "### $$$ %%%", "en", ""), (103, "x " * 50000, "zz", "")]
    labels = [(i, 1, 0) for i in range(50)] + [(7, 1, 0), (None, 1, 0), (102, 0, 0), (5, None, None), (55, 1, 1)]
    frame, marks = spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)
    rows = classify_quality(frame, marks).collect()
    assert len(rows) == len(docs)
    assert [r.keep for r in rows if r.doc_id == 102] == [False, False] and not next(r for r in rows if r.doc_id == 103).keep
    assert all(r.keep for r in rows if r.doc_id is not None and r.doc_id < 50)
    none = classify_quality(frame, marks.limit(0)).collect()
    assert len(none) == len(docs) and all(r.keep and r.perplexity == 1 for r in none)
    assert classify_quality(frame.limit(0), marks).count() == 0
    scores = spark.createDataFrame([(i, "en", 1, float(i)) for i in range(60)], "doc_id long, lang string, n_symbols long, perplexity double")
    assert with_thresholds(scores, marks, 0.5).filter("keep").count() == 25


def test_every_language_has_a_model(spark):
    """However many there are, each language's trusted text is in a model of its own and in that of all."""
    docs = [(i, f"{chr(97 + i % 26)}{chr(97 + i // 26)} " * 9, f"l{i}", "") for i in range(80)]
    frame, marks = spark.createDataFrame(docs, DOCS), spark.createDataFrame([(i, 1, 0) for i in range(80)], LABELS)
    models = trained_models(trusted_sample(frame, marks))
    assert {r.lang for r in models["g0"].collect()} == {ANY, *(d[2] for d in docs)}
    for lang in ("l0", "l79", ANY):
        plain = Plain([t for _, t, one, _ in docs if lang in (one, ANY)])
        rows = spark.createDataFrame([(0, docs[79][1] + "zz", lang, "")], DOCS)
        assert math.isclose(perplexities(rows, models).first().perplexity, plain.perplexity(docs[79][1] + "zz"), rel_tol=1e-4)


def test_sample_is_the_least_hashes(spark):
    docs = [(i, f"t{i}", ("en", "de", None)[i % 7 % 3], "") for i in range(900)]
    frame, marks = spark.createDataFrame(docs, DOCS), spark.createDataFrame([(i, 1, i % 5 == 0) for i in range(800)], "doc_id long, quality int, toxic boolean").withColumn("toxic", F.col("toxic").cast("int"))
    got = {(r.lang, r.text) for r in trusted_sample(frame, marks, 20).collect()}
    hashes = {r.doc_id: r.h for r in frame.select("doc_id", F.xxhash64("doc_id").alias("h")).collect()}
    want = set()
    for lang in ("en", "de", None):
        ids = sorted((i for i, _, one, _ in docs if one == lang and i < 800 and i % 5), key=hashes.get)[:20]
        want |= {(lang or ANY, f"t{i}") for i in ids}
    assert got == want


def test_lookup():
    rng = np.random.default_rng(4)
    keys = np.unique(rng.integers(0, 2**40, 5000, dtype=np.uint64))
    table = Lookup(keys, np.arange(len(keys), dtype=np.float32))
    assert (table.get(keys)[0] == np.arange(len(keys))).all()
    assert not table.get(keys + np.uint64(2**41))[1].any()
    assert ANY == "*"


def test_all_trusted_documents_count(spark):
    """However many a language has; a document without a language counts once in the model of all."""
    docs = [(i, f"w{i} again", "en" if i % 50 else None, "") for i in range(1500)] + [(2000, "w3 w1499 x", "zz", "")]
    frame, marks = spark.createDataFrame(docs, DOCS), spark.createDataFrame([(i, 1, 0) for i in range(1500)], LABELS)
    got = {r.doc_id: r.perplexity for r in classify_quality(frame, marks).filter("doc_id in (3, 1499, 1450, 2000)").collect()}
    own, whole = Plain([t for _, t, lang, _ in docs[:1500] if lang]), Plain([t for _, t, _, _ in docs[:1500]])
    for i, model in ((3, own), (1499, own), (1450, whole), (2000, whole)):
        text = next(t for d, t, _, _ in docs if d == i)
        assert math.isclose(got[i], model.perplexity(text), rel_tol=1e-4)
