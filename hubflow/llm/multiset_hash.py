"""Document fingerprints: a homomorphic multiset hash of paragraphs, in DataFrame operations only.

A paragraph (a line that is not empty) hashes to a wide vector; a document's fingerprint is the sum of its paragraphs'
vectors.  Sums do not depend on order, equal multisets give equal sums, and a paragraph is inserted or deleted by
adding or subtracting its vector (``combine``).  The vector has two parts: EQUAL lanes modulo 2^32, which
tell multisets apart, and SIGN lanes of +1 or -1 modulo 2^32, whose inner products estimate how many
paragraphs two documents share (the noise of a cosine is about 1 / sqrt(SIGN)).

Definitions: a null text is an empty one, whose fingerprint is all zero; equal fingerprints have likeness 1;
rows equal in doc_id and text are one document here and get equal rows; documents are ordered by doc_id (null
first), then by a hash of the text; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hubflow.llm.common import parallelism, written

EQUAL, SIGN = 8, 64
EQUAL_MODULUS, SIGN_MODULUS = 1 << 32, 1 << 32


def lane_sums(paragraph) -> list:
    """Aggregates over paragraphs: EQUAL lanes, then SIGN lanes; a null paragraph adds nothing."""
    base = F.sha2(F.encode(paragraph, "UTF-8"), 256)
    there = paragraph.isNotNull()
    equal = [F.sum(F.when(there, F.shiftrightunsigned(F.xxhash64(base, F.lit(k)), 32))).alias(f"e{k}") for k in range(EQUAL)]
    signs = F.col("_signs")
    sign = [F.sum(F.when(there, (F.shiftright(signs, k).bitwiseAND(F.lit(1)) * 2 - 1))).alias(f"s{k}") for k in range(SIGN)]
    return [*equal, *sign]


def signed(lane):
    """The value nearest to zero that equals ``lane`` modulo SIGN_MODULUS."""
    half = SIGN_MODULUS // 2
    return F.pmod(lane + half, F.lit(SIGN_MODULUS)) - half


def fingerprints(texts: DataFrame, keys: list[str], text: str) -> DataFrame:
    """keys, fingerprint (hex), signs (its SIGN lanes as numbers) for each distinct key, which may have several rows."""
    parts = (texts.select(*keys, F.explode(F.split(F.coalesce(F.col(text), F.lit("")), "\n")).alias("_p"))
             .withColumn("_p", F.when(F.col("_p") != "", F.col("_p")))
             .withColumn("_signs", F.xxhash64(F.sha2(F.encode("_p", "UTF-8"), 256), F.lit(-1))))
    summed = parts.groupBy(*keys).agg(*lane_sums(F.col("_p")))
    equal = [F.coalesce(F.col(f"e{k}"), F.lit(0)) % EQUAL_MODULUS for k in range(EQUAL)]
    sign = [F.coalesce(F.col(f"s{k}"), F.lit(0)) for k in range(SIGN)]
    return summed.select(*keys, F.concat(*[F.lpad(F.lower(F.hex(x)), 8, "0") for x in equal],
                                         *[F.lpad(F.lower(F.hex(F.pmod(x, F.lit(SIGN_MODULUS)))), 8, "0") for x in sign]).alias("fingerprint"),
                         F.array(*[signed(x).cast("int") for x in sign]).alias("signs"))


def numbers(fingerprint) -> tuple:
    """(EQUAL lanes, signed SIGN lanes) of a hex fingerprint."""
    one = lambda at, width: F.conv(F.substring(fingerprint, at, width), 16, 10).cast("long")
    equal = F.array(*[one(1 + 8 * k, 8) for k in range(EQUAL)])
    sign = F.array(*[signed(one(1 + 8 * EQUAL + 8 * k, 8)) for k in range(SIGN)])
    return equal, sign


def combine(a, b, minus: bool = False):
    """Fingerprint of two multisets together, or of the first without the second."""
    side = -1 if minus else 1
    (ea, sa), (eb, sb) = numbers(a), numbers(b)
    return F.concat(*[F.lpad(F.lower(F.hex(F.pmod(ea[k] + side * eb[k], F.lit(EQUAL_MODULUS)))), 8, "0") for k in range(EQUAL)],
                    *[F.lpad(F.lower(F.hex(F.pmod(sa[k] + side * sb[k], F.lit(SIGN_MODULUS)))), 8, "0") for k in range(SIGN)])


def likeness(a, b, signs_a, signs_b):
    """1 if both parts are equal, else the cosine of the sign lanes, at least 0 and below 1."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q), F.lit(0.0), lambda s, v: s + v)
    norm = F.sqrt(dot(signs_a, signs_a) * dot(signs_b, signs_b))
    cosine = F.coalesce(dot(signs_a, signs_b) / F.nullif(norm, F.lit(0.0)), F.lit(0.0))
    return F.when((a == b) & (signs_a == signs_b), 1.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(0.999999), cosine)))


def neighbours(keys: DataFrame) -> DataFrame:
    """(doc_id, k, n_chars, ...) distinct -> adds prev_doc_id, prev_k, prev_n (before the first comes the last).

    Keys are dealt to ranges of doc_id; a window runs inside each range, and only the first and last key of
    each range meet in one small window over the ranges.
    """
    spark = keys.sparkSession
    order = [F.col("doc_id").asc_nulls_first(), F.col("k")]
    n = keys.count()
    parts = max(1, min(4 * parallelism(spark), n), n // 100_000)
    ranged = written(keys.repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id()), "doc-ranges")
    inside = Window.partitionBy("part").orderBy(*order)
    lag = ranged.select("*", F.lag("n_chars").over(inside).alias("prev_n"), F.lag(F.struct("doc_id", "k")).over(inside).alias("prev"))
    first = F.min_by(F.struct("doc_id", "k", "n_chars"), F.struct(F.col("doc_id").isNotNull(), "doc_id", "k"))
    last = F.max_by(F.struct("doc_id", "k", "n_chars"), F.struct(F.col("doc_id").isNotNull(), "doc_id", "k"))
    ends = ranged.groupBy("part").agg(first.alias("first"), last.alias("last"))
    line = Window.orderBy("part")
    whole = line.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = ends.select(F.col("part").alias("p"), F.coalesce(F.lag("last").over(line), F.last("last").over(whole)).alias("before"))
    joined = lag.join(before, F.col("part") == F.col("p"))
    prev = F.coalesce("prev", F.struct(F.col("before.doc_id").alias("doc_id"), F.col("before.k").alias("k")))
    return joined.select(*keys.columns, prev["doc_id"].alias("prev_doc_id"), prev["k"].alias("prev_k"),
                         F.when(F.col("prev").isNotNull(), F.col("prev_n")).otherwise(F.col("before.n_chars")).alias("prev_n"))


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text keeps all but the last floor(n / 2) characters and goes on with as many of the next
    document's first ones.  The texts move once, to their key; what a document lends to the one before it (the start
    of its text, its own fingerprint) moves once.  All sums, joins and pairs after that are by the same key.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("k", F.xxhash64("text"))
    mark = lambda doc_id, k: F.concat_ws("|", doc_id.cast("string"), k.cast("string"))  # a null doc_id: the hash alone
    keys = written(rows.groupBy("doc_id", "k").agg(F.first(F.char_length("text")).cast("long").alias("n_chars"),
                                                   F.count(F.lit(1)).alias("copies")), "doc-keys")
    line = written(neighbours(keys), "doc-line").select(
        mark(F.col("doc_id"), F.col("k")).alias("key"), "doc_id", "n_chars", "copies",
        mark(F.col("prev_doc_id"), F.col("prev_k")).alias("prev"), "prev_n")
    texts = rows.select(mark(F.col("doc_id"), F.col("k")).alias("tkey"), "text").groupBy("tkey").agg(F.first("text").alias("text"))
    single = line.join(texts, F.col("key") == F.col("tkey")).drop("tkey")
    lent = single.select(F.col("prev").alias("lkey"), F.expr("substring(text, 1, cast(floor(prev_n / 2) as int))").alias("lent"))
    both = (single.join(lent, F.col("key") == F.col("lkey"))
            .withColumn("edited", F.concat(F.expr("substring(text, 1, cast(n_chars - floor(n_chars / 2) as int))"), "lent")))
    tagged = both.select("key", "doc_id", "n_chars", "copies", F.sha2(F.encode("edited", "UTF-8"), 256).alias("sha"),
                         F.explode(F.array(F.struct(F.lit(False).alias("e"), F.col("text").alias("t")),
                                           F.struct(F.lit(True).alias("e"), F.col("edited").alias("t")))).alias("x"))
    kept = ["doc_id", "n_chars", "copies", "sha"]
    prints = fingerprints(tagged.select("key", *kept, F.col("x.e").alias("e"), F.col("x.t").alias("t")), ["key", *kept, "e"], "t")
    side = lambda c, e: F.first(F.when(F.col("e") == e, F.col(c)), ignorenulls=True)
    pairs = prints.groupBy("key").agg(*[F.first(c).alias(c) for c in kept], side("fingerprint", False).alias("fingerprint"), side("signs", False).alias("signs"),
                                      side("fingerprint", True).alias("edited_fingerprint"), side("signs", True).alias("edited_signs"))
    equal = lambda c: F.substring(c, 1, 8 * EQUAL)
    lanes = fingerprints(single.select("key", "prev", "text"), ["key", "prev"], "text").select(
        F.col("prev").alias("nkey"), equal("fingerprint").alias("next_equal"), F.col("signs").alias("next_signs"))
    out = pairs.join(lanes, F.col("key") == F.col("nkey")).withColumn("_", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return out.select("doc_id", "n_chars", F.col("sha").alias("edited_sha256"), "fingerprint", "edited_fingerprint",
                      likeness(equal("fingerprint"), equal("edited_fingerprint"), F.col("signs"), F.col("edited_signs")).alias("near_edited"),
                      likeness(equal("fingerprint"), F.col("next_equal"), F.col("signs"), F.col("next_signs")).alias("near_next"))
