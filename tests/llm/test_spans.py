"""Secrets and personal data against ``re``, with awkward texts."""

from __future__ import annotations

import random

import brute
import pytest
from pyspark.sql import functions as F

from flowgrid.llm import pii_disclosure, secret_scan

SCHEMA = "doc_id long, text string, key string, base string, found string, n_chars long"


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "k", "b", "f", None if t is None else len(t)) for i, t in enumerate(texts)], SCHEMA)


AWKWARD = [
    None, "", "plain words only", "é PASSWORD = 'abc123' tail", "token=token: abcdefgh", "api_key:short api-key=x secret==abcdef",
    "AKIA" + "Q" * 16 + " AKIAshort " + "AKIAAKIA" + "Z" * 20, "x" + "0123456789abcdef" * 2 + "g", "f" * 23 + " " + "f" * 24,
    "secret: 'AKIA" + "B" * 16 + "' " + "deadbeef" * 4, "a@b.c.d_e@f.g, @x.y a@b a@b.c-d.e", "ü" * 30 + " me.you+z%@ex-1.co.uk!",
    "1.2.3.4.5 256.1.1.1 0001.2.3.255 99999999999.1.1.1", "4111 1111 1111 1111 and 4111-1111-1111-1112 and 4111  1111",
    "+1 (206) 555-0199 x+49 30 1234567890123456 +1+2 +12", "call +44.20.7946.0958-", "1" * 5000, "a" * 5000 + "@", "+" * 200,
    "password" + " " * 3000 + "x", "7 " * 4000, "\u0001 \n\t mixed \x0b 10.0.0.1\nx@y.zz", "K" + "Key token: abcdef",
]


def noisy(seed: int) -> str:
    r = random.Random(seed)
    parts = ["token", "secret", "apikey", "API_KEY", "=", ":", "'", '"', " ", "  ", "AKIA", "ABCDEF0123456789", "abcdef0123456789", "@",
             ".", "-", "+", "1", "42", "255", "256", "a.b", "x_y", "é", "\n", "(", ")", "4111111111111111", "x@y.z", "%"]
    return "".join(r.choice(parts) for _ in range(r.randint(1, 120)))


def test_spans_equal_plain_regular_expressions(spark):
    texts = [*AWKWARD, *[noisy(s) for s in range(250)]]
    got = {r.doc_id: r for r in secret_scan.digests(frame(spark, texts)).collect()}
    own = {r.doc_id: r for r in pii_disclosure.digests(frame(spark, texts)).collect()}
    assert len(got) == len(own) == len(texts)
    for i, t in enumerate(texts):
        want = brute.secret_spans(t or "")
        assert got[i].base_sha256 == brute.sha(brute.listed(want, secret_scan.KINDS)), t
        assert (got[i].n_assign, got[i].n_access, got[i].n_hex) == tuple(sum(k == j for _, k, _ in want) for j in range(3))
        assert set(brute.listed(want, secret_scan.KINDS).split(",")) <= set(got[i].spans.split(","))
        pii = brute.pii_spans(t or "")
        assert own[i].base_sha256 == brute.sha(brute.listed(pii, pii_disclosure.KINDS)), t
        assert (own[i].n_email, own[i].n_ip, own[i].n_card, own[i].n_phone) == tuple(sum(k == j for _, k, _ in pii) for j in range(4))


def test_random_strings_are_found_and_identifiers_left_alone(spark):
    r = random.Random(3)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    strange = lambda n: "".join(r.choice(letters) for _ in range(n))
    train = [f"{brute.prose(i, 60)} very_long_identifier_name_{brute.prose(i, 3).replace(' ', '_')} token={strange(32)}" for i in range(120)]
    token, name = strange(40), "another_rather_long_identifier_name"
    test = [f"see {token} here", f"see {name} here"]
    got = {x.doc_id: x.spans for x in secret_scan.digests(frame(spark, [*train, *test])).collect()}
    assert got[120] == f"random:4:{4 + len(token)}"
    assert got[121] == ""
    out = {x.doc_id: x for x in secret_scan.redacted(frame(spark, [*train, *test])).collect()}
    assert out[120].text == "see [random] here" and out[120].n_chars == len("see [random] here")
    assert out[121].text == test[1] and out[0].text.endswith("[assign]")
    assert list(out[0].asDict()) == ["doc_id", "text", "key", "base", "found", "n_chars"]


def test_secrets_are_learned_from_all_texts(spark):
    """Labelled secrets that a sample of one document in three by id hash does not hold."""
    r = random.Random(5)
    strange = lambda n: "".join(r.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789") for _ in range(n))
    held = [x.id for x in spark.range(60000).where(F.pmod(F.xxhash64("id"), F.lit(3)) != 0).limit(120).collect()]
    docs = spark.range(60000).select(F.col("id").alias("doc_id"), F.lit("ordinary identifier_names here").alias("text"))
    secrets = spark.createDataFrame([(i, f"token={strange(32)}") for i in held], "doc_id long, text string")
    token = strange(40)
    asked = spark.createDataFrame([(60000, f"see {token} here")], docs.schema)
    table = docs.join(secrets, "doc_id", "left_anti").union(secrets).union(asked)
    ratios = secret_scan.learn(table)
    assert ratios is not None
    found = secret_scan.scan(asked, ratios).select("secrets").first()[0]
    assert [(x.s, x.k, x.e) for x in found] == [(4, 3, 4 + len(token))]


def test_terms_that_give_an_entity_away_are_added(spark):
    texts = [f"{brute.prose(i, 40)} write to Quillhaven Ambrosius at boss@corp.example soon {brute.prose(900 + i, 40)}" for i in range(5)]
    texts += [brute.prose(100 + i, 80) for i in range(200)] + [f"mail x{i}@y.zz about nothing" for i in range(30)]
    got = {x.doc_id: x.spans for x in pii_disclosure.digests(frame(spark, texts)).collect()}
    at = texts[0].index("Quillhaven")
    assert f"term:{at}:{at + 10}" in got[0].split(",") and f"term:{at + 11}:{at + 20}" in got[0].split(",")
    assert all("term" not in got[i] for i in range(5, len(texts)))  # "about" and the like share no single entity
    clean = {x.doc_id: x.text for x in pii_disclosure.sanitised(frame(spark, texts)).collect()}
    assert "boss@corp" not in clean[0] and "Quillhaven" not in clean[0] and clean[10] == texts[10]


@pytest.mark.parametrize("scan", [secret_scan.digests, pii_disclosure.digests, secret_scan.redacted, pii_disclosure.sanitised])
def test_empty_table(spark, scan):
    assert scan(spark.createDataFrame([], SCHEMA)).count() == 0


def test_repeated_rows_and_null_ids(spark):
    rows = [(1, "token: abcdefg"), (1, "token: abcdefg"), (None, "a@b.cc"), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r.n_assign for r in secret_scan.digests(df).collect()) == [0, 0, 1, 1]
    assert sorted(r.n_email for r in pii_disclosure.digests(df).collect()) == [0, 0, 0, 1]


def test_native(spark):
    df = frame(spark, ["token: abcdefg"])
    for out in (secret_scan.digests(df), pii_disclosure.digests(df)):
        plan = out.select(F.col("*"))._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
