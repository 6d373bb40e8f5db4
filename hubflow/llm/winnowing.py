"""Benchmark decontamination by winnowing, in DataFrame operations only.

Texts are word sequences.  A window is ``size`` consecutive words of an item (a shorter item is one window of its own
length).  Every run of k words is hashed; of the w = size - k + 1 hashes inside a window the least is the window's
fingerprint, so that equal windows have equal fingerprints wherever they stand: every shared window is found.
A text keeps a fingerprint once per stretch of windows that it covers.  Documents' and items' fingerprints are
joined; each hit is extended to the windows around it, whose words must equal an item's window word by word.

Before the join a document drops the fingerprints whose bit is unset in a bitmap of the items' fingerprints (at
most MAX_BITS bits, whatever the size of the benchmark): only the few others, each with its own words,
leave the scan.  The bitmap loses nothing; what it lets through by chance is stopped by the joins.

Definitions: A-Z become a-z; a null or wordless text has no words and no hits; a wordless item never occurs.  Rows of items
with one item_id count as one item, with the windows of all; rows with a null item_id count as one item whose id is
written as the empty string.  Rows equal in doc_id and text get equal results, one each.  An empty table of documents gives
no rows, an empty benchmark no hits; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hubflow.llm.common import written

#: The characters that make words after A-Z became a-z, and those letters.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WINDOW, GRAM = 10, 6
#: Bounds of the bitmap; 2^23 bits are 1 MB.
MIN_BITS, MAX_BITS = 1 << 12, 1 << 23


def words_of(text) -> Column:
    """Array of words; plain ASCII takes the short way to lower case."""
    plain = F.octet_length(text) == F.char_length(text)
    low = F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.coalesce(F.regexp_extract_all(low, F.lit(WORD), F.lit(0)), F.array().cast("array<string>"))


def _shifted(c, by: int):
    return F.slice(c, F.lit(by + 1), F.greatest(F.size(c) - by, F.lit(0)))


def _doubled(df: DataFrame, name: str, combine, up_to: int) -> DataFrame:
    """Adds ``name``_2, _4 ...: place i holds the combination of places i to i + 1, i + 3 ... of ``name``_1."""
    width = 1
    while 2 * width <= up_to:
        a = F.col(f"{name}_{width}")
        df = df.withColumn(f"{name}_{2 * width}", F.zip_with(a, _shifted(a, width), combine))
        width *= 2
    return df


def _gram(df: DataFrame, k: int, out: str) -> DataFrame:
    """Adds ``out``: hashes of k consecutive words, from the hashes of 1, 2, 4 ... words."""
    done, name = 0, None
    for bit in range(k.bit_length() - 1, -1, -1):
        if k >> bit & 1:
            part = F.col(f"g_{1 << bit}")
            made = part if name is None else F.zip_with(F.col(name), _shifted(part, done), lambda a, b: F.xxhash64(a, b))
            done += 1 << bit
            name = f"{out}_{done}"
            df = df.withColumn(name, made)
    return df.withColumn(out, F.col(name))


def fingerprints(texts: DataFrame, sizes: list[int]) -> DataFrame:
    """Adds ``m<size>``: place i holds the least hash of the window of ``size`` words from word i on; needs ``words``."""
    kept = texts.columns
    df = texts.withColumn("g_1", F.transform("words", lambda x: F.xxhash64(x)))
    df = _doubled(df, "g", lambda a, b: F.xxhash64(a, b), max(map(_gram_of, sizes), default=1))
    for size in sizes:
        k = _gram_of(size)
        w = size - k + 1
        df = _gram(df, k, f"k{size}")
        df = _doubled(df.withColumn(f"l{size}_1", F.slice(f"k{size}", F.lit(1), F.greatest(F.size("words") - k + 1, F.lit(0)))),
                      f"l{size}", lambda a, b: F.least(a, b), w)
        half = 1 << (w.bit_length() - 1)
        least = F.col(f"l{size}_{half}")
        whole = least if half == w else F.zip_with(least, _shifted(least, w - half), lambda a, b: F.least(a, b))
        df = df.withColumn(f"m{size}", F.slice(whole, F.lit(1), F.greatest(F.size("words") - size + 1, F.lit(0))))
    return df.select(*kept, *[f"m{s}" for s in sizes])


def _gram_of(size: int) -> int:
    """Words of a hashed run: GRAM in whole windows; the windows of short items are hashed as they are."""
    return GRAM if size == WINDOW else size


def _starts(size: int, test=None) -> Column:
    """Windows (from 1) at which a stretch with one fingerprint begins, cut every w windows, if ``test`` holds."""
    m, w = F.col(f"m{size}"), size - _gram_of(size) + 1

    def begins(i):
        at = F.element_at(m, i)
        new = ((i - 1) % w == 0) | (at != F.element_at(m, F.greatest(i - 1, F.lit(1))))
        return new if test is None else test(at) & new
    return F.filter(F.when(F.size(m) > 0, F.sequence(F.lit(1), F.size(m))).otherwise(F.array().cast("array<int>")), begins)


def _stretches(size: int, test=None) -> Column:
    """Structs (size, m, at, span): a stretch's fingerprint, its first window, the words that its windows cover."""
    reach = 2 * size - _gram_of(size)
    return F.transform(_starts(size, test), lambda i: F.struct(
        F.lit(size).alias("size"), F.element_at(f"m{size}", i).alias("m"), (i - 1).alias("at"), F.slice("words", i, reach).alias("span")))


def _windows(words, size) -> Column:
    """Structs (at, window) of all windows of ``size`` words, as space-joined texts."""
    n = F.size(words) - size + 1
    return F.transform(F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>")),
                       lambda i: F.struct((i - 1).alias("at"), F.array_join(F.slice(words, i, size), " ").alias("window")))


def bitmap(prints: DataFrame) -> tuple[DataFrame, int]:
    """(one row with ``bits``, an array of longs; number of bits) of the distinct ``m`` of a written table."""
    n = prints.select("m").distinct().count()
    size = min(MAX_BITS, max(MIN_BITS, 1 << (16 * n).bit_length()))
    bit = F.pmod("m", F.lit(size))
    found = (prints.groupBy(F.floor(bit / 64).cast("long").alias("id"))
             .agg(F.bit_or(F.expr(f"shiftleft(1L, cast(pmod(m, {size}) % 64 as int))")).alias("x")))
    slots = prints.sparkSession.range(size // 64).join(found, "id", "left")
    pairs = F.array_sort(F.collect_list(F.struct("id", F.coalesce("x", F.lit(0).cast("long")).alias("x"))))
    return slots.agg(F.transform(pairs, lambda p: p["x"]).alias("bits")), size


def contaminated_documents(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    bench = written(items.select(F.col("item_id").cast("string").alias("item_id"), words_of(F.col("text").cast("string")).alias("words"))
                    .filter(F.size("words") > 0).withColumn("size", F.least(F.size("words"), F.lit(WINDOW))), "winnow-items")
    sizes = sorted(r["size"] for r in bench.select("size").distinct().collect())  # at most WINDOW values
    flat = written(bench.select("item_id", "size", F.explode(_windows(F.col("words"), F.col("size"))).alias("x"))
                   .select("item_id", "size", "x.window").distinct(), "winnow-windows")
    windows = written(flat.select("size", "window").distinct().withColumn("window_id", F.monotonically_increasing_id()), "winnow-window-ids")
    holders = flat.join(windows, ["size", "window"]).select("window_id", F.coalesce("item_id", F.lit("")).alias("item_id"))
    prints = written(_all_stretches(fingerprints(bench, sizes), sizes, "size").select("x.size", "x.m").distinct(), "winnow-item-prints")
    bits, n_bits = bitmap(prints)

    key = F.concat_ws("|", F.col("doc_id").cast("string"), F.xxhash64("text").cast("string"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.select("doc_id", key.alias("key"), words_of(F.col("text")).alias("words")).withColumn("bits", bits.scalar())

    def known(m):
        slot = F.pmod(m, F.lit(n_bits))
        word = F.element_at("bits", (F.floor(slot / 64) + 1).cast("int"))
        return F.getbit(word, (slot % 64).cast("int")) == 1
    none = F.array().cast("array<struct<size:int,m:bigint,at:int,span:array<string>>>")
    found = F.concat(none, *[_stretches(s, known) for s in sizes])
    marked = written(fingerprints(rows, sizes).select("doc_id", "key", F.size("words").cast("long").alias("n_words"), found.alias("found")), "winnow-docs")

    stretches = marked.select("key", F.explode("found").alias("x")).select("key", "x.*").join(prints, ["size", "m"], "left_semi")
    extended = (stretches.select("key", "size", "at", F.explode(_windows(F.col("span"), F.col("size"))).alias("w"))
                .select("key", "size", (F.col("at") + F.col("w.at")).alias("at"), "w.window"))
    hits = written(extended.join(windows, ["size", "window"]).select("key", "at", (F.col("at") + F.col("size")).alias("stop"), "window_id").distinct(),
                   "winnow-hits")
    before = Window.partitionBy("key").orderBy("at", "stop").rowsBetween(Window.unboundedPreceding, -1)
    fresh = F.greatest(F.lit(0), F.col("stop") - F.greatest("at", F.coalesce(F.max("stop").over(before), F.lit(0))))
    covered = hits.select("key", "at", "stop").distinct().select("key", fresh.alias("x")).groupBy("key").agg(F.sum("x").alias("n_hit"))
    named = hits.select("key", "window_id").distinct().join(holders, "window_id").select("key", "item_id").distinct()
    named = named.groupBy("key").agg(F.array_sort(F.collect_list("item_id")).alias("ids"))
    per_doc = covered.join(named, "key")
    out = marked.select("doc_id", "key", "n_words").join(per_doc, "key", "left")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    ids = F.coalesce("ids", F.array().cast("array<string>"))
    return out.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size(ids).cast("long").alias("n_items"),
                      F.sha2(F.encode(F.array_join(ids, ","), "UTF-8"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def _all_stretches(df: DataFrame, sizes: list[int], own: str) -> DataFrame:
    """One row ``x`` for each stretch of the windows whose size is the row's own."""
    none = F.array().cast("array<struct<size:int,m:bigint,at:int,span:array<string>>>")
    return df.select(F.explode(F.concat(none, *[F.when(F.col(own) == s, _stretches(s)).otherwise(none) for s in sizes])).alias("x"))
