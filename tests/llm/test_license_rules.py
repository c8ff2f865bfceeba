import random
import re

from tallyloom.llm.license_rules import BASE, one_of, rules, scan_licenses


def words_of(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def base(text):
    words = words_of(text)
    hits = [(i, label) for phrase, label in BASE for p in [phrase.split()] for i in range(len(words)) if words[i : i + len(p)] == p]
    starts = [i for i, _ in hits]
    return len(words), len(hits), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in hits}))


def brute(text):
    """All matches of all rules, whatever their keywords, and of every two of them whether one hides the other."""
    line, found = f" {' '.join(words_of(text))} ", set()
    for label, priority, _, pattern, versioned in rules():
        for m in re.finditer(f" {pattern}(?= )", line, re.A):
            name = f"{label}-{m[1].replace(' ', '.')}" if versioned else label
            found.add((line[: m.start()].count(" "), m[0].count(" "), priority, name))
    hides = lambda b, a: b[0] <= a[0] and a[0] + a[1] <= b[0] + b[1] and (b[2] > a[2] or b[2] == a[2] and b[1] > a[1])
    return sorted(a for a in found if not any(hides(b, a) for b in found))


def result(spark, rows):
    frame = spark.createDataFrame([(d, t, "x", 3) for d, t in rows], "doc_id long, text string, words string, n_words int")
    return scan_licenses(frame).collect()


def test_whole_documents(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    rows += [(-1, None), (-2, ""), (-3, " .,-"), (-4, "mit license mit license MIT-License"), (-5, "CC BY cc  by CC\nBY, cc.by xcc by ccby cc by4"), (None, "é İ K"), (None, "Apache\tLICENSE é"), (-6, "w " * 50000 + "GNU General  Public_License"), (-7, "ſ mıt license cc by mit licenses")]
    got = sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in result(spark, rows)), key=str)
    assert got == sorted(((d, *base(t)) for d, t in rows), key=str)


def test_detections_against_brute_force(spark, sf):
    rng = random.Random(6)
    parts = [re.sub(r"\(\?:[^()]*\)[?{][^ ]*|\(\?:|\)\??|\[\^ \]\+|\[cs\]", lambda m: "s" if m[0] == "[cs]" else "", p.replace("(?: version)? v?(\\d(?: \\d){0,2})", " version 2 0")) for _, _, _, p, _ in rules()]
    parts += ["cc by nc sa 4.0", "GPLv3", "version 2", "1 0", "or later", "gnu", "the", "license", "licence", "v3", "mit", "under the", "public domain", "Creative Commons Attribution-NonCommercial 3.0"]
    texts = [" ".join(rng.choices(parts, k=rng.randrange(1, 14))) for _ in range(1500)] + parts + [None, "", "all rights reserved " * 3000]
    texts += [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    hits = 0
    for r in result(spark, list(enumerate(texts))):
        want = brute(texts[r.doc_id])
        assert sorted((d.first_word, d.n_words, d.priority, d.label) for d in r.detections) == want, texts[r.doc_id]
        n_base, labels = base(texts[r.doc_id])[1::3]
        assert r.labels == ",".join(sorted({*(x for x in labels.split(",") if x), *(x[3] for x in want)}))
        assert abs(r.score - max([0.6 if n_base else 0.0, *(x[2] / 100 for x in want)])) < 1e-9
        hits += len(want)
    assert hits > 5000


def test_rules(spark):
    assert len(rules()) > 250
    for _, _, key, pattern, versioned in rules():
        assert re.search(rf"(?<![a-z0-9]){key}(?![a-z])", pattern) and re.compile(pattern).groups == versioned, pattern
    cases = {
        "Licensed under the Apache License, Version 2.0.": "apache,apache-2.0",
        "Licensed under CC BY-NC 4.0.": "cc-by,cc-by-nc-4.0",
        "This work is licensed under the GNU General Public License, version 3.": "gpl,gpl-3",
        "GNU Lesser General Public License v2.1 or later": "lgpl-2.1",
        "under the BSD 3-Clause license": "bsd-3-clause",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files": "mit",
        "It has no licence words": "",
        "All rights reserved. Mozilla Public License 2.0": "all-rights-reserved,mpl-2.0",
        "gnu is an animal": "",
    }
    for r, (text, labels) in zip(sorted(result(spark, list(enumerate(cases))), key=lambda r: r.doc_id), cases.items(), strict=True):
        assert r.labels == labels, (text, r.labels, r.detections)
        assert 0 <= r.score <= 1 and (r.score > 0) == bool(labels)


def test_one_of():
    words = ["a", "ab", "abc", "b", "ba", "xyz"]
    assert all(re.fullmatch(one_of(words), w) for w in words) and not any(re.fullmatch(one_of(words), w) for w in ("", "x", "xy", "abcd", "bab"))


def test_no_python(spark, sf):
    plan = scan_licenses(spark.read.parquet(f"{sf}/documents.parquet"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Exchange" not in plan
    assert scan_licenses(spark.read.parquet(f"{sf}/documents.parquet").limit(0)).count() == 0
