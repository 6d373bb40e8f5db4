"""Mixing sources to target weights by balanced sampling with the cube method.

Each source gets a target share of all words, so its documents are taken ``target / source_size`` times on
average: the whole part of that rate for every document, and its fraction as an inclusion probability.
The cube method then turns the fractions into 0 or 1 while two totals per source hold: words and documents.
The flight phase moves three undecided documents at a time along the direction that keeps both totals (the cross
product of their constraint rows) until one is decided; two are left at last.  Documents fly in blocks of
bounded size, largest first; what a block leaves undecided flies again, joined with what other blocks of its
source left, until a source has one block, whose landing decides the last two so that the words come nearest to their total.

Definitions: a document's size is its number of words (null: 0); documents without words are never taken;
rows with equal doc_id and text share one decision; a source is compared by code point, null last; other columns
are ignored; an empty table gives no rows.  Every draw is a hash of the seed, the round and the documents,
so reruns agree, on any number of tasks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hubflow.llm.common import written

#: Documents that fly together, and how often a document may be taken.
BLOCK, REPEATS = 4_096, 3
WORDS = r"[^\x20\x09-\x0D]+"


def word_count(text):
    """Number of words: starts of runs of characters other than space and U+0009-U+000D."""
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), repeats: int = REPEATS) -> DataFrame:
    """(source, source_size) -> adds weight and target.

    Sources by code point weigh 1, 2, 3, 1, ...; targets share all words by weight, stop at ``repeats`` times a
    source's size, and the excess is shared again by weight.  That ends where target = min(cap, level * weight):
    sorted by cap / weight, the stopped sources are a prefix, and the level follows from running sums.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())  # one row for each source
    ranked = sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int")).cast("double"))
    ranked = ranked.withColumn("cap", F.col("source_size").cast("double") * repeats).withColumn("ratio", F.col("cap") / F.col("weight"))
    line = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before = line.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    levels = (ranked.withColumn("_rest", F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
              .withColumn("_weights", F.sum("weight").over(line.rowsBetween(0, Window.unboundedFollowing)))
              .withColumn("_level", F.col("_rest") / F.col("_weights")))
    # the first source whose cap is not below the level that the rest would get: all from there on get the level
    level = F.min(F.when(F.col("ratio") >= F.col("_level"), F.struct("ratio", "_level"))).over(everything)["_level"]
    return levels.withColumn("target", F.least("cap", F.coalesce(level * F.col("weight"), F.col("cap")))).select(
        "source", "source_size", "weight", "target")


def _draw(seed: int, round_: int, key: int, step: int) -> float:
    """A number in [0, 1) from a 64-bit mix of its arguments."""
    x = (key ^ seed * 0x9E3779B97F4A7C15 ^ (round_ << 56) ^ step * 0xBF58476D1CE4E5B9) & 0xFFFFFFFFFFFFFFFF
    for m in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB):
        x = (x ^ x >> 30) * m & 0xFFFFFFFFFFFFFFFF
    return (x ^ x >> 31) / 2.0 ** 64


def flight(chance: list[float], size: list[float], key: list[int], seed: int, round_: int) -> list[float]:
    """Moves the chances, taken in the given order, until at most two lie strictly between 0 and 1.

    sum(chance) and sum(chance * size) stay what they were, up to rounding.
    """
    chance, eps = list(chance), 1e-9
    hand: list[int] = []
    for nxt in range(len(chance)):
        if chance[nxt] <= eps or chance[nxt] >= 1 - eps:
            chance[nxt] = float(chance[nxt] > 0.5)
            continue
        hand.append(nxt)
        if len(hand) < 3:
            continue
        a, b, c = (size[i] for i in hand)
        move = (c - b, a - c, b - a)  # (1, 1, 1) x sizes: changes neither total
        if not any(move):
            move = (1.0, -1.0, 0.0)  # equal sizes: any move between two of them
        up = min(((1 - chance[i]) / m if m > 0 else chance[i] / -m) for i, m in zip(hand, move) if m)
        down = min((chance[i] / m if m > 0 else (1 - chance[i]) / -m) for i, m in zip(hand, move) if m)
        step = up if _draw(seed, round_, key[nxt], nxt) * (up + down) < down else -down
        left = []
        for i, m in zip(hand, move):
            chance[i] += step * m
            if chance[i] <= eps or chance[i] >= 1 - eps:
                chance[i] = float(chance[i] > 0.5)
            else:
                left.append(i)
        hand = left
    return chance


def landing(chance: list[float], size: list[float]) -> list[float]:
    """Decides the last undecided documents: the combination whose words come closest to their due, then the one
    of fewer documents.  While words are over or short, one taken and one untaken document change places, or one
    document changes, where that comes closest to the total that the chances had.
    """
    due = sum(p * s for p, s in zip(chance, size))
    chance = list(chance)
    open_ = [i for i, p in enumerate(chance) if 0 < p < 1]
    choices = []
    for mask in range(1 << len(open_)):
        for k, i in enumerate(open_):
            chance[i] = float(mask >> k & 1)
        choices.append((abs(due - sum(p * s for p, s in zip(chance, size))), mask))
    mask = min(choices, default=(0.0, 0))[1]
    for k, i in enumerate(open_):
        chance[i] = float(mask >> k & 1)
    while True:
        taken = sorted((s, i) for i, (p, s) in enumerate(zip(chance, size)) if p == 1)
        spare = sorted((s, i) for i, (p, s) in enumerate(zip(chance, size)) if p == 0 and s)
        short = due - sum(s for s, _ in taken)
        moves = [(abs(short), 0, ())]
        moves += [(abs(short + s), 1, (i,)) for s, i in taken] + [(abs(short - s), 1, (i,)) for s, i in spare]
        if taken and spare:
            sizes = np.array([s for s, _ in spare])
            for s, i in taken:
                at = int(np.searchsorted(sizes, s + short))
                for k in (at - 1, at):
                    if 0 <= k < len(spare):
                        moves.append((abs(short + s - spare[k][0]), 0, (i, spare[k][1])))
        best = min(moves)
        if best[0] > abs(short) - 0.5:  # less than a word nearer
            break
        for i in best[2]:
            chance[i] = 1 - chance[i]
    return chance


def _fly(seed: int, round_: int, land: bool):
    """Flies one block; the last block of a source also lands."""
    def run(t):
        rank = np.lexsort((t["text_key"].to_numpy(), t["doc_id"].to_pandas().fillna(-1).to_numpy(), -t["words"].to_numpy()))
        t = t.take(pa.array(rank))
        size, key = [float(x) for x in t["words"].to_pylist()], t["text_key"].to_pylist()
        chance = flight(t["chance"].to_pylist(), size, key, seed, round_)
        if land:
            chance = landing(chance, size)
        return t.set_column(t.schema.get_field_index("chance"), "chance", pa.array(chance, pa.float64()))
    return run


def mix_sources(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), repeats: int = REPEATS, seed: int = 42) -> DataFrame:
    """doc_id, text_key, size, source, source_size, target, copies, taken (= copies * size), a row for each document."""
    rows = written(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"),
                               word_count(F.col("text")).alias("size"), F.col("source").cast("string").alias("source")), "mix-sizes")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = written(source_targets(sizes, weights, repeats)
                      .withColumn("rate", F.coalesce(F.expr("target / nullif(source_size, 0)"), F.lit(0.0)))
                      .withColumn("code", F.xxhash64("source", F.col("source").isNull())), "mix-sources")
    units = (rows.groupBy("source", "doc_id", "text_key", "size").agg(F.count(F.lit(1)).alias("n"))
             .withColumn("words", F.col("size") * F.col("n")).withColumn("code", F.xxhash64("source", F.col("source").isNull())))
    rates = sources.select("code", "rate", F.lit(repeats).alias("most"))
    flying = (units.join(rates, "code").withColumn("whole", F.floor("rate"))
              .withColumn("chance", F.when(F.col("size") == 0, 0.0).otherwise(F.col("rate") - F.col("whole")))
              .select("code", "doc_id", "text_key", "size", "words", "whole", "chance"))
    flying = written(flying, "mix-units")
    kind = ", ".join(f"{c} {t}" for c, t in flying.dtypes)
    decided = flying.filter("chance <= 0")
    flying = flying.filter("chance > 0")
    round_ = 0
    while True:
        counts = [r["n"] for r in flying.groupBy("code").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n").alias("n")).collect()]
        most = counts[0] or 0
        last = most <= BLOCK
        blocks = 1 if last else -(-2 * most // BLOCK)
        dealt = flying.withColumn("block", F.pmod(F.xxhash64("doc_id", "text_key", F.lit(round_)), F.lit(blocks)))
        out = written(dealt.groupBy("code", "block").applyInArrow(
            _fly(seed, round_, last), kind + ", block long").select(*flying.columns), "mix-flight")
        decided = decided.union(out.filter("chance <= 0 or chance >= 1"))
        if last:
            break
        flying, round_ = out.filter("chance > 0 and chance < 1"), round_ + 1
    copies = decided.select(F.col("code").alias("c"), F.col("doc_id").alias("d"), F.col("text_key").alias("k"), F.col("size").alias("s"),
                            (F.col("whole") + (F.col("chance") > 0).cast("long")).cast("long").alias("copies"))
    facts = sources.select(F.col("code").alias("sc"), "source_size", "target")
    coded = rows.withColumn("code", F.xxhash64("source", F.col("source").isNull()))
    joined = (coded.join(copies, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_key") == F.col("k")) & (F.col("size") == F.col("s"))
                         & (F.col("code") == F.col("c")))
              .join(facts, F.col("code") == F.col("sc")))
    return joined.select("doc_id", "text_key", "size", "source", "source_size", "target", "copies",
                         (F.col("copies") * F.col("size")).cast("long").alias("taken"))
