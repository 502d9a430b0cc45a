"""The corpus pipeline stage by stage against plain versions, on the smallest tables."""

from __future__ import annotations

import os

import brute
import pytest
from test_shingle_join import firsts

import corpus_pipeline
from flowgrid.llm import nb_svm
from flowgrid.llm.common import stored, table

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")
def test_stages_equal_plain_versions(spark):
    docs = table(spark, SF, "documents")
    columns = docs.columns
    rows = {r.doc_id: r.text for r in docs.collect()}
    model = nb_svm.learn(docs, table(spark, SF, "labels"))
    items = [brute.re.findall(r"[^\W_]+", r.text.lower()) for r in table(spark, SF, "benchmark").collect()]
    for name, stage in corpus_pipeline.STAGES:
        out = stored(stage(spark, docs, SF), name)
        if name == "quality":
            rows = {i: t for i, t in rows.items() if model.score((t or "").encode()) >= 0.7}
        elif name == "near_duplicates":
            kept = firsts(list(rows.items()))
            rows = {i: t for i, t in rows.items() if i in kept}
        elif name == "benchmark_leaks":
            text = {i: " " + " ".join(brute.re.findall(r"[^\W_]+", (t or "").lower())) + " " for i, t in rows.items()}
            rows = {i: t for i, t in rows.items() if not any(f" {' '.join(w)} " in text[i] for w in items)}
        elif name == "secrets":
            got = {r.doc_id: r.text for r in out.collect()}
            for i, t in rows.items():
                assert (got[i] == t) == (not brute.secret_spans(t)) or "[random]" in got[i]
                assert not brute.secret_spans(got[i].replace("[assign]", " ").replace("[hex]", " ").replace("[access]", " "))
            rows = got
        else:
            plain = brute.tiktoken_encoder()
            for r in out.collect():
                ids = plain.encode_ordinary(rows[r.doc_id])
                assert r.n_tokens == len(ids) and r.decoded_sha256 == brute.sha(rows[r.doc_id])
                assert r.ids_sha256 == brute.sha(b"".join(i.to_bytes(4, "little") for i in ids))
        assert {r.doc_id for r in out.select("doc_id").collect()} == set(rows)
        if name != "token_ids":
            assert out.columns == columns
        docs = out
    assert docs.count() > 50


def test_stages_take_odd_tables(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long, score double, key string"
    rows = [(1, None, None, None, None, None, None), (None, "x y z", "en", "s", 5, 1.0, "k"), (2, "", "en", "s", 0, 1.0, "k"), (2, "", "en", "s", 0, 1.0, "k")]
    folder = str(tmp_path)
    spark.createDataFrame([(9, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    for start in (rows, []):
        docs = spark.createDataFrame(start, schema)
        for name, stage in corpus_pipeline.STAGES:
            out = stored(stage(spark, docs, folder), name)
            if name != "token_ids":
                assert out.columns == docs.columns
            docs = out
