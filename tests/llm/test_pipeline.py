import sys

from test_near_copies import brute as near
from test_pattern_packing import check_pack
from test_substring_dedup import brute as passages

import corpus_pipeline as p


def test_stages_against_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    all_rows = {r.doc_id: r.text for r in docs.collect()}
    quality = p.quality(spark, docs, sf).cache()
    good = {r.doc_id: r.text for r in quality.collect()}
    assert good.items() <= all_rows.items() and quality.columns == p.COLUMNS
    clean = {r.doc_id for r in spark.read.parquet(f"{sf}/labels.parquet").filter("quality = 1 and toxic = 0").collect()}
    junk = {r.doc_id for r in spark.read.parquet(f"{sf}/labels.parquet").filter("quality = 0").collect()}
    assert len(clean - set(good)) <= 0.03 * len(clean) and len(junk & set(good)) <= 0.2 * len(junk)

    single = p.near_duplicates(spark, quality, sf).cache()
    assert {r.doc_id for r in single.collect()} == {min(x)[1] for x in near(list(good.items()))}

    kept = p.repeated_passages(spark, single, sf).cache()
    want = {d: (t, n) for d, _, n, t in passages([(r.doc_id, r.text) for r in single.collect()])}
    for r in kept.collect():
        text, removed = want[r.doc_id]
        assert r.text == (text if removed else good[r.doc_id]) and r.n_chars == len(r.text)
    assert kept.count() == single.count() and kept.columns == p.COLUMNS

    pieces = p.packing(spark, kept, sf).collect()
    check_pack(pieces, [(r.doc_id, r.text) for r in kept.collect()])


def test_rows_of_one_id_are_judged_by_themselves(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select(p.COLUMNS)
    scored = p.classify_quality(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    bad, good = (scored.filter(x).limit(3).join(docs, "doc_id").select(docs["text"], docs["lang"], docs["source"], docs["n_chars"]) for x in ("not keep", "keep"))
    both = bad.unionByName(good).selectExpr("cast(null as long) doc_id", "*").unionByName(bad.unionByName(good).selectExpr("-5L doc_id", "*")).cache()
    left = p.quality(spark, docs.unionByName(both), sf).filter("doc_id is null or doc_id = -5")
    assert sorted(r.text for r in left.collect()) == sorted(2 * [r.text for r in good.collect()])


def test_run_and_edges(spark, sf, tmp_path):
    assert [n for n, _ in p.STAGES] == ["quality", "near_duplicates", "repeated_passages", "packing"]
    rows = [(1, "a b c", "en", "s", 5), (1, "a b c", "en", "s", 5), (2, None, None, None, None), (None, "z y", "en", None, 3), (None, None, None, None, None)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = p.run(spark, f"file://{tmp_path}").collect()
    assert [r.doc_id for r in got] == [1]  # all other texts, with an id or without, are less probable than the only trusted one
    assert "corpus_pipeline" in sys.modules
