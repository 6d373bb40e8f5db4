"""Ranked lexical search: accumulators from short lists, then document-at-a-time skipping over long ones.

The index is a table of postings (document, term, impact), dealt over shards by document.  In a shard, a query's short
lists are summed term by term into accumulators; the documents with one become a single iterator in document
order, with the largest accumulator as its bound.  It joins the long lists in a document-at-a-time pass: iterators are
ordered by their bounds, those whose bounds together stay below the score of the k-th best so far offer no
candidates and are only probed, at the documents that can still reach that score.  Documents pass in blocks, so
that each step is one numpy call.  Impacts are integers, so every order of summing gives the same score.

Only the queries' terms are indexed, of every document: a worker drops the terms whose bit is unset in a bitmap of the
queries' vocabulary (at most MAX_BITS bits), a join with the vocabulary drops the rest.  Queries are searched in
blocks of bounded size, each broadcast to the shards.  A shard returns k documents a query; they are ranked
in a window that keeps k rows a task before its shuffle.

Definitions: a null or empty text has no terms; every row is a document, repeated rows too; equal scores rank by
doc_id, null last, then in no promised order.  Rows of items with one item_id (null too) are one
item, with the terms of all.  Empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hubflow.llm.common import written

#: A-Z become a-z; digits, letters and bytes of other characters make terms; the score's constants.
_PLAIN = b"0123456789abcdefghijklmnopqrstuvwxyz"
TERM_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or c in _PLAIN else 32 for c in range(256))
WEIGHT_SCALE, TF_SCALE, TF_STEP, LENGTH_STEP, LENGTH_SHARE = 1000, 1_000_000_000, 1000, 8, 90
MIN_BITS, MAX_BITS = 1 << 12, 1 << 23
POSTINGS_PER_SHARD, PAIRS_PER_BLOCK = 500_000, 200_000
#: A list is short if it holds at most this share of a shard's documents; documents of a block of the pass.
SHORT_SHARE, BLOCK = 1 / 16, 1024


def terms_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(TERM_BYTES).split()


def _item_terms(batches):
    for b in batches:
        ids, terms = [], []
        for at in range(b.num_rows):
            for t in set(terms_of(b.column(1)[at].as_py())):
                ids.append(b.column(0)[at].as_py())
                terms.append(t.decode())
        yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(terms, pa.string())], names=["item_id", "term"])


def _doc_terms(shared, n_bits: int):
    """doc_id, n, and the terms that may be in the vocabulary, with their counts."""
    def run(batches):
        bits = shared.value
        for b in batches:
            ids, ns, terms, tfs, ends = [], [], [], [], [0]
            for at in range(b.num_rows):
                found = terms_of(b.column(1)[at].as_py())
                if not found:
                    continue
                ids.append(b.column(0)[at].as_py())
                ns.append(len(found))
                for t, tf in Counter(found).items():
                    h = zlib.crc32(t) % n_bits
                    if bits[h >> 3] >> (h & 7) & 1:
                        terms.append(t.decode())
                        tfs.append(tf)
                ends.append(len(terms))
            at = pa.array(ends, pa.int32())
            yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(ns, pa.int64()), pa.ListArray.from_arrays(at, pa.array(terms, pa.string())),
                                   pa.ListArray.from_arrays(at, pa.array(tfs, pa.int64()))], names=["doc_id", "n", "terms", "tfs"])
    return run


def _bitmap(vocabulary: DataFrame) -> tuple[bytes, int]:
    """Bits of the terms' checksums, and their number."""
    n = vocabulary.count()
    size = min(MAX_BITS, max(MIN_BITS, 1 << (16 * n).bit_length()))
    slot = F.crc32(F.encode("term", "UTF-8")) % size
    rows = (vocabulary.select(F.floor(slot / 64).cast("long").alias("id"), F.expr(f"shiftleft(1L, cast(crc32(encode(term, 'UTF-8')) % {size} % 64 as int))").alias("x"))
            .groupBy("id").agg(F.bit_or("x").alias("x")).collect())  # at most MAX_BITS / 64 rows
    words = np.zeros(size // 64, "<i8")
    for r in rows:
        words[r["id"]] = r["x"]
    return words.tobytes(), size


class Shard:
    """Posting lists of one shard; documents are numbered in the order of ranks among equal scores."""

    def __init__(self, doc: np.ndarray, doc_id: np.ndarray, nameless: np.ndarray, term: np.ndarray, impact: np.ndarray):
        order = np.lexsort((doc, doc_id, nameless))
        _, first, place = np.unique(doc[order], return_index=True, return_inverse=True)
        # distinct documents by their first place in that order
        rank = np.empty(len(first), np.int64)
        rank[np.argsort(first, kind="stable")] = np.arange(len(first))
        number = np.empty(len(doc), np.int64)
        number[order] = rank[place]
        self.n_docs = len(first)
        self.row = np.empty(self.n_docs, np.int64)
        self.row[number] = np.arange(len(doc))
        by_list = np.lexsort((number, term))
        self.docs, self.impacts = number[by_list], impact[by_list]
        terms, starts = np.unique(term[by_list], return_index=True)
        stops = np.append(starts[1:], len(term))
        tops = np.maximum.reduceat(self.impacts, starts) if len(term) else starts
        self.lists = {t: (a, b, m) for t, a, b, m in zip(terms.tolist(), starts.tolist(), stops.tolist(), tops.tolist())}

    def search(self, terms, weights, k: int, short_share: float = SHORT_SHARE, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
        """(document numbers, scores) of the k best documents with a score above 0, best first."""
        limit = short_share * self.n_docs
        sums = np.zeros(self.n_docs, np.int64)
        runs = []  # (bound, documents, impacts, weight) of every iterator
        for t, w in zip(terms, weights):
            if w > 0 and t in self.lists:
                a, b, top = self.lists[t]
                if b - a <= limit:
                    sums[self.docs[a:b]] += w * self.impacts[a:b]
                elif top > 0:
                    runs.append((w * top, self.docs[a:b], self.impacts[a:b], w))
        touched = np.flatnonzero(sums)
        floor = 0
        if len(touched):
            summed = sums[touched]
            runs.append((int(summed.max()), touched, summed, 1))
            if len(touched) >= k:
                floor = int(np.partition(summed, len(summed) - k)[len(summed) - k])
        runs.sort(key=lambda r: r[0])
        below = np.cumsum([r[0] for r in runs])  # what the iterators up to each can add together
        best_docs, best = np.empty(0, np.int64), np.empty(0, np.int64)
        for lo in range(0, self.n_docs, block):
            offered = int(np.searchsorted(below, floor, side="left"))  # iterators before it cannot reach the floor by themselves
            if offered == len(runs):
                break
            part, seen = np.zeros(block, np.int64), np.zeros(block, bool)
            for _, docs, impacts, w in runs[offered:]:
                a, b = np.searchsorted(docs, (lo, lo + block))
                if a < b:
                    part[docs[a:b] - lo] += w * impacts[a:b]
                    seen[docs[a:b] - lo] = True
            alive = np.flatnonzero(seen)
            for at in range(offered - 1, -1, -1):
                alive = alive[part[alive] + below[at] >= floor]
                if not len(alive):
                    break
                _, docs, impacts, w = runs[at]
                place = np.minimum(np.searchsorted(docs, alive + lo), len(docs) - 1)
                hit = docs[place] == alive + lo
                part[alive[hit]] += w * impacts[place[hit]]
            alive = alive[(part[alive] >= floor) & (part[alive] > 0)]
            if len(alive):
                docs, scores = np.append(best_docs, alive + lo), np.append(best, part[alive])
                keep = np.lexsort((docs, -scores))[:k]
                best_docs, best = docs[keep], scores[keep]
                if len(best) == k:
                    floor = max(floor, int(best[-1]))
        return best_docs, best


def _search(shared, k: int):
    def run(table: pa.Table) -> pa.Table:
        col = lambda c: table.column(c).combine_chunks()
        ids = col("doc_id")
        nameless = ids.is_null().to_numpy(zero_copy_only=False)
        number = ids.fill_null(0).to_numpy()
        doc = col("doc").to_numpy()
        shard = Shard(doc, number, nameless, col("term_id").to_numpy(), col("impact").to_numpy())
        items, rows, scores = [], [], []
        for item, (terms, weights) in enumerate(shared.value):
            found, best = shard.search(terms, weights, k)
            items.append(np.full(len(found), item, np.int32))
            rows.append(shard.row[found])
            scores.append(best)
        at = np.concatenate(rows) if rows else np.empty(0, np.int64)
        return pa.table({"item": np.concatenate(items) if items else np.empty(0, np.int32), "doc_id": ids.take(pa.array(at)), "doc": doc[at],
                         "score": np.concatenate(scores) if scores else np.empty(0, np.int64)})
    return run


def index_documents(docs: DataFrame, vocabulary: DataFrame, purpose: str = "lexical") -> tuple[DataFrame, int]:
    """(written postings: shard, doc, doc_id, term_id, impact; number of documents with a term)."""
    spark = docs.sparkSession
    bits, n_bits = _bitmap(vocabulary)
    shared = spark.sparkContext.broadcast(bits)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    terms = written(rows.mapInArrow(_doc_terms(shared, n_bits), "doc_id long, n long, terms array<string>, tfs array<long>")
                    .withColumn("doc", F.monotonically_increasing_id()), f"{purpose}-documents")
    total = terms.agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("terms"), F.sum(F.size("terms")).alias("pairs")).first()
    n_docs, n_terms = total["docs"], max(1, total["terms"] or 0)
    shards = -(-(total["pairs"] or 1) // POSTINGS_PER_SHARD)
    flat = terms.select("doc", "doc_id", "n", F.explode(F.arrays_zip("terms", "tfs")).alias("x")).select("doc", "doc_id", "n", F.col("x.terms").alias("term"), F.col("x.tfs").alias("tf"))
    length = f"({100 - LENGTH_SHARE}L + (({LENGTH_SHARE}L * n * {n_docs}L) div {n_terms}L))"
    impact = F.expr(f"({TF_SCALE}L * tf) div ({TF_STEP}L * tf + {LENGTH_STEP}L * {length})")
    postings = flat.join(vocabulary, "term").select(F.pmod(F.xxhash64("doc"), F.lit(max(1, shards))).cast("int").alias("shard"),
                                                    "doc", "doc_id", "term_id", impact.alias("impact"))
    return written(postings, f"{purpose}-postings"), n_docs


def rank_documents(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """item_id, rank, doc_id, score of each item's k best documents."""
    spark = docs.sparkSession
    pairs = written(items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
                    .mapInArrow(_item_terms, "item_id long, term string").distinct(), "lexical-items")
    vocabulary = written(pairs.select("term").distinct().withColumn("term_id", F.monotonically_increasing_id()), "lexical-vocabulary")
    postings, n_docs = index_documents(docs, vocabulary)
    weight = F.floor(F.lit(float(WEIGHT_SCALE)) * F.log(F.lit(2.0 * n_docs + 2.0) / (2.0 * F.col("df") + 1.0))).cast("long")
    weights = vocabulary.join(postings.groupBy("term_id").agg(F.count(F.lit(1)).alias("df")), "term_id").select("term", "term_id", weight.alias("w"))
    asked = written(pairs.join(weights, "term").select("item_id", "term_id", "w"), "lexical-queries")
    blocks = max(1, -(-asked.count() // PAIRS_PER_BLOCK))
    found = None
    for block in range(blocks):
        rows = (asked.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block).groupBy("item_id")
                .agg(F.collect_list("term_id").alias("terms"), F.collect_list("w").alias("weights")).collect())  # some PAIRS_PER_BLOCK pairs
        shared = spark.sparkContext.broadcast([(r["terms"], r["weights"]) for r in rows])
        names = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(rows)], "item int, item_id long")
        best = postings.groupBy("shard").applyInArrow(_search(shared, k), "item int, doc_id long, doc long, score long")
        part = written(best.join(names, "item").select("item_id", "doc_id", "doc", "score"), "lexical-found")
        found = part if found is None else found.unionByName(part)
    rank = F.row_number().over(Window.partitionBy("item_id").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last(), "doc"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
