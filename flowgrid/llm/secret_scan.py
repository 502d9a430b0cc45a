"""Secret scans with character Markov models, in DataFrame functions only.

Three fixed patterns find assignments, access keys and long hex runs. A fourth kind, ``random``, is any run of 20 or more
token characters, outside those, that reads more like a random string than like an identifier: two first-order Markov
models over ASCII characters, one of random strings, one of ordinary identifiers, are compared by their mean
log-likelihood ratio per step.

The models learn from all texts: values that the fixed patterns mark are random strings, other tokens of eight or more
characters are ordinary. Bigram counts, 2 x 128 x 128 numbers at most, are all that reaches the driver. Every text is
scanned whole.

Nulls and edges: a null text is empty and has no spans; without a labelled secret in any text no ``random`` span is
added; repeated rows get equal results; an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowgrid.llm import spans
from flowgrid.llm.common import text_of

# Fixed values of the contract.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
KINDS = ("assign", "access", "hex", "random")

# The same matches after the length rules; runs start where no longer one could.
LONG_ACCESS, LONG_HEX = r"AKIA[A-Z0-9]{16,}+", r"(?<![0-9a-f])[0-9a-f]{24,}+"
TOKEN, ORDINARY = (r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{%d,}+" % n for n in (20, 8))
ASCII = 128


def value(match: Column) -> Column:
    return F.regexp_extract(match, ASSIGN, 1)


def base(text: Column) -> Column:
    """Spans of the three fixed kinds."""
    low = F.lower(text)
    word = low.contains("password") | low.contains("passwd") | low.contains("secret") | low.contains("token") | low.contains("api")
    return spans.merged(spans.find(text, ASSIGN, 0, lambda v: F.length(value(v)) >= 6, word),
                        spans.find(text, LONG_ACCESS, 1, lambda v: F.lit(True), text.contains("AKIA")),
                        spans.find(text, LONG_HEX, 2, lambda v: F.lit(True)))


def steps(token: Column) -> Column:
    """Character pairs of a token as numbers 128 * first + second."""
    chars = F.filter(F.split(token, ""), lambda c: c != "")
    n = F.size(chars)
    return F.zip_with(F.slice(chars, 1, F.greatest(n - 1, F.lit(0))), F.slice(chars, 2, F.greatest(n - 1, F.lit(0))),
                      lambda a, b: F.ascii(a) * ASCII + F.ascii(b))


def learn(docs: DataFrame, smooth: float = 0.5, weight: float = 256.0) -> list[float] | None:
    """Log-likelihood ratio of every character pair, random over ordinary; None without examples of both.

    Pair frequencies are interpolated with the frequencies of the second characters of the same class, which count as
    ``weight`` further pairs: a first character never or hardly seen in a class is no evidence by itself, and a random string
    that no pattern marks does not pass for an ordinary one because it is among the ordinary tokens.
    """
    marked = docs.select(text_of().alias("text")).withColumn("base", base(F.col("text")))
    secret = F.transform("base", lambda x: F.when(x["k"] == 0, value(x["v"])).otherwise(x["v"]))
    other = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.col("text"), ASSIGN, " "), LONG_ACCESS, " "), LONG_HEX, " ")
    tokens = F.concat(F.transform(secret, lambda v: F.struct(F.lit(1).alias("y"), v.alias("v"))),
                      F.transform(F.regexp_extract_all(other, F.lit(ORDINARY), 0),
                                  lambda v: F.struct(F.lit(0).alias("y"), v.alias("v"))))
    counts = (marked.select(F.explode(tokens).alias("t")).groupBy("t.y", "t.v").agg(F.count(F.lit(1)).alias("n"))
              .select("y", "n", F.explode(steps(F.col("v"))).alias("step")).groupBy("y", "step").agg(F.sum("n")).collect())
    seen = [[0] * (ASCII * ASCII) for _ in range(2)]
    used = set()
    for y, step, n in counts:
        seen[y][step] += n
        used |= {step // ASCII, step % ASCII}
    if not all(map(any, seen)):
        return None
    log = [[0.0] * (ASCII * ASCII) for _ in range(2)]
    for y in range(2):
        after = [sum(seen[y][b::ASCII]) + smooth for b in range(ASCII)]  # how often each character follows any other
        share = [n / (sum(after) - smooth * (ASCII - len(used))) for n in after]
        for a in range(ASCII):
            row = seen[y][a * ASCII:(a + 1) * ASCII]
            for b in range(ASCII):
                log[y][a * ASCII + b] = math.log((row[b] + weight * share[b]) / (sum(row) + weight))
    return [round(r - o, 6) for o, r in zip(*log, strict=True)]


def scan(docs: DataFrame, ratios: list[float] | None, least: float = 0.5) -> DataFrame:
    """``docs`` with columns ``secrets_base`` and ``secrets``: arrays of (s, k, e, v) sorted by start and kind."""
    text = text_of()
    found = docs.withColumn("secrets_base", base(text))
    if ratios is None:
        return found.withColumn("secrets", F.col("secrets_base"))
    table = F.split(F.lit(",".join(map(str, ratios))), ",").cast("array<double>")  # folded to one constant

    def random(v: Column) -> Column:
        pairs = steps(v)
        total = F.aggregate(pairs, F.lit(0.0), lambda acc, p: acc + F.coalesce(F.get(table, p), F.lit(0.0)))
        return total >= least * F.size(pairs)

    more = spans.find(text, TOKEN, 3, random)
    return (found.withColumn("__more", more).withColumn("secrets", spans.merged(F.col("secrets_base"), F.filter(
        "__more", lambda x: ~spans.overlaps(F.col("secrets_base"), x["s"], x["e"])))).drop("__more"))


def digests(docs: DataFrame) -> DataFrame:
    found = scan(docs.select("doc_id", "text"), learn(docs))
    b = F.col("secrets_base")
    return found.select("doc_id", spans.count(b, 0).alias("n_assign"), spans.count(b, 1).alias("n_access"),
                        spans.count(b, 2).alias("n_hex"), F.sha2(spans.listing(b, KINDS), 256).alias("base_sha256"),
                        spans.listing(F.col("secrets"), KINDS).alias("spans"))


def redacted(docs: DataFrame) -> DataFrame:
    """``docs`` with every secret in ``text`` replaced by its kind; ``n_chars``, where there is one, follows."""
    found = scan(docs, learn(docs))
    out = found.withColumn("text", F.when(F.size("secrets") > 0, spans.redact(F.col("text"), F.col("secrets"), KINDS))
                           .otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.size("secrets") > 0, F.length("text").cast(docs.schema["n_chars"].dataType))
                             .otherwise(F.col("n_chars")))
    return out.select(*docs.columns)
