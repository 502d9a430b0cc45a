"""Decontamination, host reputation, classifier, BPE and top-k search."""

from __future__ import annotations

import math
import os

import brute
import numpy as np
import pytest

from flowgrid.llm import decontaminate, host_reputation, maxscore, nb_svm, spm_bpe

DOCS = "doc_id long, text string, key string, term string, score double, ids string, decoded string"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "a", "b", 0.0, "c", "d") for i, t in rows], DOCS)


def test_benchmark_items_are_found_and_nothing_else(spark, monkeypatch):
    items = [(i, brute.prose(500 + i, 14 + i)) for i in range(30)] + [(90, None), (91, ""), (92, "...")]
    clean = [(i, brute.prose(i, 400)) for i in range(60)]
    copies = [(100 + i, f"{brute.prose(i, 70)} {items[i][1]} {brute.prose(i + 50, 70)}") for i in range(12)]
    words = items[20][1].split()
    para = [(200, " ".join([*clean[3][1].split()[:90], *("other" if i in (2, 7, 11) else w for i, w in enumerate(words))]))]
    half = [(201, " ".join([*clean[4][1].split()[:90], *words[:len(words) // 2]]))]
    long = [(202, f"{brute.prose(9, 12000)} {items[29][1].upper()} {brute.prose(10, 3000)}")]
    rows = [*clean, *copies, *para, *half, *long, (300, None), (301, ""), (None, items[0][1]), (100, copies[0][1])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = sorted([*((100 + i, i) for i in range(12)), (200, 20), (202, 29), (None, 0), (100, 0)], key=repr)
    for block in (5000, 9):
        monkeypatch.setattr(decontaminate, "ITEMS", block)
        found = decontaminate.matches(docs(spark, rows), bench).collect()
        assert sorted(((r.doc_id, r.item_id) for r in found), key=repr) == want
    kept = decontaminate.clean(docs(spark, rows), bench)
    assert kept.columns == DOCS.replace(" long", "").replace(" string", "").replace(" double", "").split(", ")
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted([*range(60), 201, 300, 301], key=repr)
    assert decontaminate.matches(docs(spark, []), bench).count() == 0
    assert decontaminate.matches(docs(spark, rows), bench.limit(0)).count() == 0


def test_lcs_equals_the_table():
    r = np.random.default_rng(2)
    for _ in range(50):
        a, b = r.integers(0, 5, r.integers(1, 30)), r.integers(0, 5, r.integers(0, 40))
        table = np.zeros((len(a) + 1, len(b) + 1), int)
        for i in range(len(a)):
            for j in range(len(b)):
                table[i + 1, j + 1] = table[i, j] + 1 if a[i] == b[j] else max(table[i, j + 1], table[i + 1, j])
        assert decontaminate.lcs(decontaminate._masks(a), len(a), b.tolist()) == table[-1, -1]


def test_host_reputation_shrinks_and_blocks(spark):
    bad, good = "http://bad.x.org/p", "https://Good.x.org/p?q#f"
    urls = [bad] * 40 + [good] * 40 + ["http://new.x.org/", None, "no scheme", "ftp://www.example.com/en/a", "http://a.example.com/en/b",
                                       "http://example.com/de", "http://example.com", "//x", "http://exAMPLE.net/es/1"]
    pages = spark.createDataFrame([(i, u, "h", True) for i, u in enumerate(urls)], "page_id long, url string, host string, bad boolean")
    outcomes = spark.createDataFrame([(i, i < 40) for i in range(80)] + [(80, None), (None, True)], "page_id long, bad boolean")
    rules = (("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"))
    got = {r.page_id: r for r in host_reputation.judge(pages, outcomes, rules).collect()}
    assert [got[i].verdict for i in (0, 40, 80, 81, 82)] == ["block", "allow", "allow", "allow", "allow"]
    assert (got[40].host, got[40].path) == ("good.x.org", "/p") and (got[81].host, got[82].path) == ("", "")
    assert [(got[i].rule, got[i].verdict) for i in (83, 84, 85, 88)] == [
        ("www.example.com/en/", "allow"), ("example.com/en/", "block"), ("com/", "allow"), ("net/es/", "block")]
    assert got[86].rule is None and got[86].path == ""
    parts = pages.selectExpr("page_id", "lower(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1)) AS host")
    low = {r.host: r for r in host_reputation.reputation(parts, outcomes).collect()}
    assert 0.5 < low["bad.x.org"].bad_mean < 1 and low["good.x.org"].bad_mean < 0.2
    assert abs(low["new.x.org"].bad_mean - 0.5) < 0.2 and low["new.x.org"].bad_low < low["bad.x.org"].bad_low
    assert host_reputation.judge(pages.limit(0), outcomes, rules).count() == 0
    assert host_reputation.judge(pages, outcomes.limit(0), rules).count() == len(urls)


SF = "/root/testdata/sf0.01"


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")
def test_classifier_on_held_out_rows(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = nb_svm.learn(table, labels)
    scored = nb_svm.score(table, model).join(labels, "doc_id").where("crc32(cast(doc_id AS string)) % 4 = 2").collect()
    right = sum((r.quality_score >= 0.7) == bool(r.quality) for r in scored)
    assert right / len(scored) >= 0.95
    from pyspark.sql import functions as F
    wrong = labels.withColumn("quality", F.when(nb_svm.remainder(F.col("doc_id")) == 2, 1 - F.col("quality")).otherwise(F.col("quality")))
    again = nb_svm.learn(table, wrong)
    assert (again.weights == model.weights).all() and (again.a, again.b) == (model.a, model.b)


def test_classifier_edges(spark):
    table = docs(spark, [(1, None), (2, ""), (3, "ab"), (4, "word " * 30000), (None, "text"), (1, None)])
    labels = lambda rows: spark.createDataFrame(rows, "doc_id long, quality int")
    for rows in ([], [(1, 1), (3, 1)], [(1, None), (None, 0), (3, 7)], [(1, 1), (1, 0), (3, 0), (4, 1), (5, 1)]):
        model = nb_svm.learn(table, labels(rows))
        out = nb_svm.score(table, model).collect()
        assert len(out) == 6 and all(0 <= r.quality_score <= 1 for r in out)
        assert nb_svm.score(table.limit(0), model).count() == 0
    assert nb_svm.features(b"x x x y").tolist()[-2:] == [1 << 16, (1 << 16) + 1]


def test_classifier_learns_from_every_labelled_row(spark):
    """What only rows far down the order of id hashes show is learned; the fit once stopped at 12,000 rows."""
    from pyspark.sql import functions as F

    late = [r.doc_id for r in spark.range(24000).withColumnRenamed("id", "doc_id").where(nb_svm.remainder(F.col("doc_id")) != 2)
            .orderBy(F.xxhash64("doc_id"), "doc_id").collect()][12000:]
    ids = spark.range(24000).select(F.col("id").alias("doc_id"), F.col("id").isin(late).alias("late"))
    table = ids.select("doc_id", F.when(F.col("late"), "zqzq").when(F.col("doc_id") % 3 == 0, "bad one").otherwise("good one").alias("text"))
    labels = ids.select("doc_id", (~F.col("late") & (F.col("doc_id") % 3 != 0)).cast("int").alias("quality"))
    model = nb_svm.learn(table, labels)
    assert len(late) > 5000
    assert model.score(b"zqzq") < 0.2 and model.score(b"bad one") < 0.2 and model.score(b"good one") > 0.8
    assert nb_svm.learn(table, labels).score(b"zqzq") == model.score(b"zqzq")


def test_labelled_rows_are_found_by_the_bitmap(spark):
    from pyspark.sql import functions as F

    table = spark.range(3000).select(F.when(F.col("id") > 0, F.col("id") - 1500).alias("doc_id"))
    chosen = table.where("doc_id % 7 = 0").distinct()
    got = {r.doc_id for r in nb_svm.marked(table, chosen).collect()}
    assert {r.doc_id for r in chosen.collect()} <= got and len(got) < 450  # 428 are


def test_descent_finds_the_hinge_optimum():
    r = np.random.default_rng(0)
    rows = [(np.flatnonzero(r.random(12) < 0.4).astype(np.int32), int(y)) for y in r.choice([-1, 1], 40)]
    ratio2 = r.random(12) + 0.1
    alpha, w, b = nb_svm.descend(rows, np.zeros(40), np.zeros(12), 0.0, ratio2, 0.5, 400)
    v = w / np.sqrt(ratio2)
    primal = 0.5 * (v @ v + b * b) + 0.5 * sum(max(0, 1 - y * (w[on].sum() + b)) for on, y in rows)
    dual = alpha.sum() - 0.5 * (v @ v + b * b)
    assert math.isclose(primal, dual, rel_tol=1e-3)


STRANGE = [None, "", " ", "Hello world's   two  spaces \n\n x", "naïve Ünïcödé 東京 🎉🎉 ‍﻿", "a" * 3000, "\x00\x01\x1c\x85\xa0 ",
           "don't I'LL we've 12345 3.14 ½ Ⅷ", "\t\t\r\n 　x", "Ġ Ċ ▁ <unk> <|endoftext|>", "!!!???...", "é" * 500, " " * 700 + "x"]


def test_bpe_equals_tiktoken_and_decodes(spark):
    import public_tokenizers

    texts = [*STRANGE, *[brute.prose(i, 200) for i in range(20)], *[brute.edited(brute.prose(i, 80), i, 3) for i in range(20)]]
    df = docs(spark, list(enumerate(texts)))
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    got = {r.doc_id: r for r in spm_bpe.digests(df, path, public_tokenizers.PATTERN, keep_ids=True).collect()}
    plain = brute.tiktoken_encoder()
    for i, t in enumerate(texts):
        ids = plain.encode_ordinary(t or "")
        assert np.frombuffer(bytes(got[i].ids), "<u4").tolist() == ids, t
        assert (got[i].n_tokens, got[i].ids_sha256) == (len(ids), brute.sha(np.array(ids, "<u4").tobytes()))
        assert got[i].decoded_sha256 == brute.sha(t or "")
    both = spm_bpe.encode(df.drop("ids"), path, public_tokenizers.PATTERN)
    assert both.columns == [*df.drop("ids").columns, "ids"]
    back = spm_bpe.decode(both.drop("decoded"), path).select("doc_id", "decoded").collect()
    assert all(bytes(r.decoded).decode() == (texts[r.doc_id] or "") for r in back)
    assert spm_bpe.digests(df.limit(0), path, public_tokenizers.PATTERN).count() == 0


def test_every_token_is_itself():
    import public_tokenizers

    ranks = spm_bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    table = spm_bpe._byte_table(spm_bpe.serialise(ranks))
    assert all(ranks[t] == i for i, t in enumerate(table)) and len(table) == len(ranks)


def best(vectors, k, every):
    out = []
    clean = {}
    for i, v in vectors:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            clean.setdefault(i, []).append([math.floor(64 * float(x)) for x in v])
    for q in clean:
        if q % every == 0:
            scores = {c: max(sum(a * b for a, b in zip(x, y)) for x in clean[q] for y in clean[c]) for c in clean if c != q}
            ranked = sorted(scores.items(), key=lambda s: (-s[1], s[0]))[:k]
            out += [(q, r + 1, c, s) for r, (c, s) in enumerate(ranked)]
    return sorted(out)


@pytest.mark.parametrize("rows", [37, 8192])
def test_top_k_equals_brute_force(spark, rows):
    r = np.random.default_rng(4)
    vectors = [(i, [float(x) for x in r.normal(0, 0.3, 12)]) for i in range(260)]
    vectors += [(300 + i, vectors[0][1]) for i in range(30)]  # ties
    vectors += [(400, None), (401, [None] * 12), (402, [float("nan")] * 12), (403, [float("inf")] * 12), (None, vectors[1][1]), (404, []),
                (420, [1.0, -2.0]), (20, vectors[20][1]), (441, [1e7] * 12), (460, [-1e7] * 12)]
    df = spark.createDataFrame([(i, v, "q", 1) for i, v in vectors], "vec_id long, embedding array<double>, query_id string, score int")
    got = sorted(tuple(x) for x in maxscore.top_k(df, 20, 20, 64, rows).collect())
    assert got == best(vectors, 20, 20)
    assert maxscore.top_k(df.limit(0)).count() == 0
