"""Information-theoretic sanitisation of personal data, in DataFrame functions only.

Fixed patterns find e-mail and IP addresses, payment cards and phone numbers: the protected entities. Terms near an
entity can reveal it after it is gone. Over the corpus, a term's disclosure of an entity is their pointwise mutual
information over the entity's information content, PMI(t, e) / IC(e) = log(N n(t,e) / (n(t) n(e))) / log(N / n(e)), from
counts of distinct texts; 1 means the term gives the entity away. Terms within ``NEAR`` characters of an entity that
share it in at least ``support`` texts and reach ``threshold`` are spans of kind ``term``: to be removed, or generalised
to their kind.

n(t) counts texts of the whole corpus. Before words are shuffled they pass a bitmap of the candidate terms' hashes, of
fixed size, which lets some others through but none of the candidates out. Entities and terms are joined by hash keys
and pre-aggregated; nothing is collected but the bitmap.

Nulls and edges: a null text is empty and has no spans; texts without entities get no terms; equal texts count once
and get equal results; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowgrid.llm import spans
from flowgrid.llm.common import stored, text_key, text_of

KINDS = ("email", "ip", "card", "phone", "term")
# The contract's patterns. Runs are taken whole and start where no longer one could, so that long runs cost linear time.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
WORD = r"[\p{L}\p{N}]{4,}"
NEAR, BITS = 60, 20


def digits(v: Column) -> Column:
    return F.regexp_replace(v, r"[^0-9]", "")


def luhn(v: Column) -> Column:
    """Check sum of a digit string: from the right, every second digit doubled."""
    d = F.transform(F.filter(F.split(F.reverse(v), ""), lambda c: c != ""), lambda c: c.cast("int"))
    part = F.transform(d, lambda x, i: F.when(i % 2 == 0, x).otherwise(F.when(x > 4, 2 * x - 9).otherwise(2 * x)))
    return F.aggregate(part, F.lit(0), lambda acc, x: acc + x) % 10 == 0


def base(text: Column) -> Column:
    part = lambda p: F.regexp_replace(p, "^0+(?=[0-9])", "")
    small = lambda v: F.forall(F.split(v, r"\."), lambda p: (F.length(part(p)) <= 3) & (part(p).cast("int") <= 255))
    card = lambda v: F.length(digits(v)).between(14, 19) & luhn(digits(v))
    return spans.merged(spans.find(text, EMAIL, 0, lambda v: F.lit(True), text.contains("@")), spans.find(text, IP, 1, small),
                        spans.find(text, CARD, 2, card),
                        spans.find(text, PHONE, 3, lambda v: F.length(digits(v)).between(10, 15), text.contains("+")))


def windows(text: Column, found: Column) -> Column:
    """Array of (entity, term, s, e): words within NEAR characters of an entity, outside every entity."""
    def near(x: Column) -> Column:
        lo = F.greatest(x["s"] - NEAR, F.lit(0))
        part = F.substring(text, lo + 1, x["e"] - lo + NEAR)
        words = spans.find(part, WORD, 4, lambda v: F.lit(True))
        # a word cut by the window's edge is not one
        whole = F.filter(words, lambda w: ((w["s"] > 0) | (lo == 0)) & ((w["e"] < F.length(part)) | (lo + w["e"] == F.length(text))))
        placed = F.transform(whole, lambda w: F.struct(
            F.xxhash64(x["v"], x["k"]).alias("entity"), F.lower(w["v"]).alias("term"), (lo + w["s"]).alias("s"), (lo + w["e"]).alias("e")))
        return F.filter(placed, lambda w: ~spans.overlaps(found, w["s"], w["e"]))
    return F.flatten(F.transform(found, near))


def disclosing(near: DataFrame, docs: DataFrame, threshold: float, support: int) -> DataFrame:
    """(entity, term) pairs whose disclosure reaches the threshold. ``near``: key, w of distinct texts with entities."""
    pairs = stored(near.select("key", F.explode("w").alias("w")).select("key", "w.entity", "w.term").distinct()
                   .groupBy("entity", "term").agg(F.count(F.lit(1)).alias("both")).where(F.col("both") >= support), "pairs")
    held = near.select(F.explode(F.array_distinct(F.transform("found", lambda x: F.xxhash64(x["v"], x["k"])))).alias("entity"))
    entities = stored(held.groupBy("entity").agg(F.count(F.lit(1)).alias("n_entity")), "entities")
    slot = F.expr(f"pmod(xxhash64(term), {1 << BITS}L)")
    bit = "cast(slot % 64 AS int)"
    marks = {int(r[0]): int(r[1]) for r in pairs.select(slot.alias("slot")).groupBy(F.expr("slot div 64").alias("w")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, {bit})"))).collect()}  # 2^(BITS-6) rows at most
    bitmap = F.split(F.lit(",".join(str(marks.get(i, 0)) for i in range(1 << (BITS - 6)))), ",").cast("array<bigint>")
    texts = docs.select(text_key(text_of()).alias("key"), text_of().alias("text"))
    word = (texts.select("key", F.explode(F.array_distinct(F.split(F.lower("text"), r"[^\p{L}\p{N}]+"))).alias("term"))
            .where(F.length("term") >= 4).withColumn("slot", slot)
            .withColumn("marks", F.get(bitmap, F.expr("cast(slot div 64 AS int)")))
            .where(F.expr(f"shiftright(marks, {bit}) & 1L = 1L")).select("key", "term"))
    n_term = word.distinct().groupBy("term").agg(F.count(F.lit(1)).alias("n_term"))
    total = texts.select("key").distinct().count()
    gain = F.log(total * F.col("both") / (F.col("n_term") * F.col("n_entity"))) / F.log(total / F.col("n_entity"))
    counts = stored(n_term, "term-counts")
    return (pairs.join(entities, "entity").join(counts, "term").where(F.col("n_entity") < total)
            .where(gain >= threshold).select("entity", "term"))


def scan(docs: DataFrame, threshold: float = 0.9, support: int = 3) -> DataFrame:
    """doc_id, key, pii_base and pii: arrays of (s, k, e, v) sorted by start and kind, of every row of ``docs``."""
    rows = stored(docs.select("doc_id", text_key(text_of()).alias("key"), text_of().alias("text"))
                  .withColumn("found", base(F.col("text")))
                  .select("doc_id", "key", "found", F.when(F.size("found") > 0, windows(F.col("text"), F.col("found"))).alias("w")),
                  "entities-near")
    near = stored(rows.where(F.size("found") > 0).select("key", "found", "w").groupBy("key")
                  .agg(F.min(F.struct("found", "w")).alias("r")).select("key", "r.found", "r.w"), "near")
    reveal = stored(disclosing(near, docs, threshold, support), "disclosing")
    terms = (near.select("key", F.explode("w").alias("w")).select("key", "w.entity", "w.term", "w.s", "w.e")
             .join(reveal, ["entity", "term"])
             .groupBy("key").agg(F.array_sort(F.collect_set(F.struct(
                 F.col("s"), F.lit(4).alias("k"), F.col("e"), F.col("term").alias("v")))).alias("terms")))
    added = stored(terms, "terms")
    return (rows.drop("w").join(added, "key", "left")
            .select("doc_id", "key", F.col("found").alias("pii_base"),
                    spans.merged(F.col("found"), F.coalesce("terms", F.array().cast(spans.SPAN))).alias("pii")))


def digests(docs: DataFrame) -> DataFrame:
    found = scan(docs)
    b = F.col("pii_base")
    return found.select("doc_id", *[spans.count(b, i).alias(f"n_{k}") for i, k in enumerate(KINDS[:4])],
                        F.sha2(spans.listing(b, KINDS), 256).alias("base_sha256"),
                        spans.listing(F.col("pii"), KINDS).alias("spans"))


def sanitised(docs: DataFrame) -> DataFrame:
    """``docs`` with entities and disclosing terms in ``text`` generalised to their kind; all columns stay."""
    found = stored(scan(docs).where(F.size("pii") > 0).select("key", "pii").groupBy("key").agg(F.min("pii").alias("pii"))
                   .select(F.col("key.a").alias("__a"), F.col("key.b").alias("__b"), F.col("pii").alias("__pii")), "pii")
    key = text_key(text_of())
    return (docs.withColumns({"__a": key["a"], "__b": key["b"]}).join(found, ["__a", "__b"], "left")
            .withColumn("text", F.when(F.col("__pii").isNotNull(), spans.redact(F.col("text"), F.col("__pii"), KINDS))
                        .otherwise(F.col("text"))).select(*docs.columns))
