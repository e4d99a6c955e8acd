"""The pipeline's stages on a small table: what each keeps and returns."""

import random

import corpus_pipeline as P

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, extra int"


def _docs():
    random.seed(8)
    words = {"en": "the cat dog house river stone walks under every bright morning and".split(),
             "de": "der hund katze haus fluss stein geht unter jeden hellen morgen und".split()}
    para = lambda g, n: " ".join(random.choice(words[g]) for _ in range(n))
    rows = [(i, para("en" if i % 2 else "de", 120), "en" if i % 2 else "de") for i in range(60)]
    shared = para("en", 40)
    rows[10] = (10, rows[10][1] + " " + shared, "de")
    rows[20] = (20, rows[20][1] + " " + shared, "de")
    rows[30] = (30, rows[30][1] + ' token = "0123456789abcdef0123456789abcdef01234567"', "de")
    rows += [(100, rows[1][1], "en"), (101, None, "en"), (102, "12345 !!", None), (103, "", "de"), (1, rows[1][1], "en")]
    return [(*r, "src", None if r[1] is None else len(r[1]), 5) for r in rows], shared


def test_stages(spark):
    rows, shared = _docs()
    docs = spark.createDataFrame(rows, COLUMNS)
    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())
    one = P.language_id(spark, docs, "")
    assert one.columns == docs.columns and ids(one) == sorted(r[0] for r in rows if r[0] not in (101, 102, 103))
    two = P.near_dedup(spark, one, "").cache()
    assert two.columns == docs.columns and set(ids(two)) >= {10, 20, 30} and ids(two).count(1) == 1 and 100 not in ids(two)
    three = P.exact_dedup(spark, two, "").cache()
    texts = {r.doc_id: r for r in three.collect()}
    assert three.columns == docs.columns and set(texts) == set(ids(two))
    assert shared in texts[10].text and shared not in texts[20].text
    assert all(r.n_chars == len(r.text) for r in texts.values())
    four = {r.doc_id: r for r in P.secrets(spark, three, "").collect()}
    assert set(four) == set(texts) and 'token = "[SECRET]"' in four[30].text and four[30].extra == 5
    five = P.pack(spark, three, "").collect()
    assert {r.doc_id for r in five} == set(texts)


def test_stage_names_and_empty_table(spark):
    assert [n for n, _ in P.STAGES] == [
        "language_id", "simhash_near_dedup", "suffix_array_dedup", "secret_scan", "best_fit_packing"]
    docs = spark.createDataFrame([], COLUMNS)
    for _, stage in P.STAGES:
        docs = stage(spark, docs, "")
        assert docs.count() == 0
        if "sequence_id" in docs.columns:
            break
