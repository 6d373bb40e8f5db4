"""Spelling variants: one-edit neighbours in a relational trie, a frontier joined with its edges level by level.

The words of the corpus form a trie, kept as a table of nodes with their edges.  A state (word, node, kind of edit)
says that the word, read up to some place, has led to a node; a level joins all states at one depth with that depth's
nodes.  A state without an edit follows its own letter and branches into replaced, inserted and deleted letters; a
state with its edit behind it follows letters that match.  States whose word ends at a word's node become neighbours.

The edit may stand in the first half of a word or in the second.  Both the words and the reversed words have a trie,
and in each only the later half is edited, so that no state branches near the crowded root.  Each edge knows the
lengths left and the letters (modulo 64) beyond its child: a state that cannot end there is not made.  Every
depth's nodes are joined once.  A node that very many words share is a hot join key, which adaptive execution
splits on the side of the states.

Words of more than ``max_depth`` letters do not lengthen the loop: they and the words next to them in length meet
on polynomial hashes of the word without one letter, verified letter by letter.

Definitions: a null text has no runs; a null doc_id is written as the empty string in the checksum; rows are counted
one by one, repeated ones too; empty tables give no rows; other columns are ignored.  Words are at
least 6 code points long: shorter ones would need edits within a third of a word's length.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hubflow.llm.common import written

#: Letters of a run, the letters that become lower-case, and the checksum's divisor.
RUN = "[A-Za-zÀ-ÿ]"
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
TYPO_EVERY = 199
MIN_LETTERS, MIN_COUNT, FORM_RATIO = 6, 5, 5
#: Distinct words that a worker counts before it hands them on.
WORDS_HELD = 100_000
MAX_DEPTH = 64
EXACT, REPLACED, INSERTED, DELETED, CUT = range(5)
PRIME, BASE = (1 << 61) - 1, 1_000_003


def runs_of(doc_id, text: str | None, min_letters: int = MIN_LETTERS) -> Counter:
    """Words of one document with their counts; some lose a letter, as the checksum of document and run says."""
    found = Counter(re.findall(RUN + "{%d,}" % min_letters, (text or "").encode().translate(LOWER).decode()))
    out: Counter = Counter()
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for run, n in found.items():
        h = zlib.crc32(run.encode(), start)
        if h % TYPO_EVERY == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1:]
            if len(run) < min_letters:
                continue
        out[run] += n
    return out


def _counted(min_letters: int):
    def batch(held: Counter):
        return pa.record_batch([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])

    def run(batches):
        held: Counter = Counter()
        for b in batches:
            for at in range(b.num_rows):
                held.update(runs_of(b.column(0)[at].as_py(), b.column(1)[at].as_py(), min_letters))
                if len(held) > WORDS_HELD:
                    yield batch(held)
                    held = Counter()
        if held:
            yield batch(held)
    return run


def word_counts(docs: DataFrame, min_letters: int = MIN_LETTERS, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n) of all words with enough letters and occurrences."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return (rows.mapInArrow(_counted(min_letters), "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count))


def _bit(letter) -> Column:
    return F.pmod(F.ascii(letter), F.lit(64)).cast("int")


def trie_nodes(sided: DataFrame) -> DataFrame:
    """side, node (its prefix), depth, end (a word ends here), edges: array of (letter, ends, lo, hi, next).

    ``lo`` and ``hi`` bound the letters left from the child to the ends of its words; ``next`` has the bits of the
    letters after the child.  Nodes without edges and those above the least half of a word are left out.
    """
    least = MIN_LETTERS // 2
    after = F.substring("word", F.col("i") + 1, F.lit(1))
    prefixes = sided.select("side", "word", F.explode(F.sequence(F.lit(least), F.char_length("word"))).alias("i"))
    left = F.char_length("word") - F.col("i")
    nodes = (prefixes.select("side", F.substring("word", F.lit(1), F.col("i")).alias("node"), F.col("i").alias("depth"), left.alias("left"),
                             F.when(left > 0, F.expr("shiftleft(1L, pmod(ascii(substring(word, i + 1, 1)), 64))")).otherwise(F.lit(0).cast("long")).alias("bit"))
             .groupBy("side", "node", "depth").agg(F.min("left").alias("lo"), F.max("left").alias("hi"), F.bit_or("bit").alias("next")))
    ends = F.col("lo") == 0
    own = nodes.select("side", "node", "depth", ends.alias("end"), F.lit(None).cast("struct<letter:string,ends:boolean,lo:int,hi:int,next:bigint>").alias("edge"))
    up = nodes.filter(F.col("depth") > least).select(
        "side", F.substring("node", F.lit(1), F.col("depth") - 1).alias("node"), (F.col("depth") - 1).alias("depth"), F.lit(False).alias("end"),
        F.struct(F.substring("node", F.col("depth"), F.lit(1)).alias("letter"), ends.alias("ends"), "lo", "hi", "next").alias("edge"))
    both = own.unionByName(up).groupBy("side", "node", "depth").agg(F.max("end").alias("end"), F.collect_list("edge").alias("edges"))
    return both.filter(F.size("edges") > 0)


def _step(states: DataFrame, nodes: DataFrame, depth: int) -> DataFrame:
    """States at ``depth`` -> states one deeper and neighbours found (``found``: node is the neighbour)."""
    joined = states.join(nodes.drop("depth"), ["side", "node"]).select("side", "word", "node", "kind", "end", F.explode("edges").alias("e"))
    letters = F.char_length("word")
    place = F.lit(depth) + F.when(F.col("kind") == INSERTED, -1).when(F.col("kind") == DELETED, 1).otherwise(0)
    e = F.col("e")

    def letter(at):
        return F.substring("word", at + 1, F.lit(1))

    def open_(at):
        """The word's letters from ``at`` on may lead from the child to an end."""
        rest = letters - at
        return (rest >= e["lo"]) & (rest <= e["hi"]) & F.when(rest == 0, e["ends"]).otherwise(F.getbit(e["next"], _bit(letter(at))) == 1)
    exact = F.col("kind") == EXACT
    own = e["letter"] == letter(place)  # after the last letter this compares with the empty string
    d = F.lit(depth)
    more = letters > depth
    found = F.when(~exact, F.when(own & open_(place + 1), F.array("kind")).otherwise(F.array().cast("array<int>"))).otherwise(F.filter(F.array(
        F.when(more & own, EXACT),
        F.when(more & ~own & open_(d + 1), REPLACED),
        F.when(~own & open_(d), INSERTED),
        F.when((letters > depth + 1) & (letter(d) != letter(d + 1)) & (e["letter"] == letter(d + 1)) & open_(d + 2), DELETED),
        F.when((letters == depth + 1) & own & F.col("end"), CUT)), lambda k: k.isNotNull()))
    out = joined.select("side", "word", "node", e["letter"].alias("letter"), F.explode(found).alias("kind"))
    place = F.lit(depth + 1) + F.when(F.col("kind") == INSERTED, -1).when(F.col("kind") == DELETED, 1).otherwise(0)
    return out.select("side", "word", F.when(F.col("kind") == CUT, F.col("node")).otherwise(F.concat("node", "letter")).alias("node"),
                      F.col("kind").cast("int").alias("kind"), ((F.col("kind") != EXACT) & (place >= letters)).alias("found"))


def _trie_pairs(words: DataFrame, purpose: str) -> DataFrame:
    """(word, near) among the given words."""
    spark = words.sparkSession
    sided = words.select(F.explode(F.array(F.struct(F.lit(0).alias("side"), F.col("word").alias("word")),
                                           F.struct(F.lit(1).alias("side"), F.reverse("word").alias("word")))).alias("x")).select("x.*")
    letters = F.char_length("word")
    half = F.floor(letters / 2).cast("int")
    sided = written(sided.withColumn("half", F.when(F.col("side") == 0, half).otherwise(letters - half)), f"{purpose}-sided")
    nodes = written(trie_nodes(sided), f"{purpose}-trie")
    bounds = sided.agg(F.min("half"), F.max(letters)).first()
    schema = "side int, word string, node string, kind int"
    states, found = spark.createDataFrame([], schema), spark.createDataFrame([], "side int, word string, node string")
    for depth in range(bounds[0] or 0, (bounds[1] or -1) + 1):
        new = sided.filter(F.col("half") == depth).select("side", "word", F.substring("word", 1, depth).alias("node"), F.lit(EXACT).alias("kind"))
        level = written(_step(states.unionByName(new), nodes.filter(F.col("depth") == depth), depth), f"{purpose}-level")
        found = found.unionByName(level.filter("found").select("side", "word", "node"))
        states = level.filter("not found").select("side", "word", "node", "kind")
    turn = lambda c: F.when(F.col("side") == 0, F.col(c)).otherwise(F.reverse(c))
    return found.select(turn("word").alias("word"), turn("node").alias("near"))


def _without_one(batches):
    """Polynomial hashes of each word (place -1) and of the word without each letter."""
    for b in batches:
        for word in b.column(0).to_pylist():
            codes = list(map(ord, word))
            n = len(codes)
            tail, power = [0] * (n + 1), [1] * (n + 1)  # tail[i]: hash of the letters from i on
            for i in range(n - 1, -1, -1):
                tail[i] = (codes[i] * power[n - 1 - i] + tail[i + 1]) % PRIME
                power[n - i] = power[n - 1 - i] * BASE % PRIME
            head, hashes = 0, []
            for i, c in enumerate(codes):
                hashes.append((head * power[n - 1 - i] + tail[i + 1]) % PRIME)
                head = (head * BASE + c) % PRIME
            for at in range(-1, n, 1 << 14):
                stop = min(n, at + (1 << 14))
                some = [tail[0], *hashes[:stop]] if at < 0 else hashes[at:stop]
                k = len(some)
                yield pa.record_batch([pa.array([zlib.crc32(word.encode())] * k, pa.int64()), pa.array([tail[0]] * k, pa.int64()),
                                       pa.array([n] * k, pa.int32()), pa.array(range(at, at + k), pa.int32()), pa.array(some, pa.int64())],
                                      names=["crc", "whole", "letters", "place", "hash"])


def _long_pairs(words: DataFrame, purpose: str) -> DataFrame:
    """(word, near) among the given long words, by hashes of the word without one letter; verified."""
    marks = written(words.select("word").mapInArrow(_without_one, "crc long, whole long, letters int, place int, hash long"), f"{purpose}-long")
    me = F.struct("crc", "whole", "letters").alias("a")
    cut = marks.filter("place >= 0")
    a = cut.select(me, F.col("letters").alias("l"), F.col("place").alias("p"), F.col("hash").alias("h"))
    replaced = a.join(a.withColumnRenamed("a", "b"), ["l", "p", "h"]).filter("a != b").select("a", "b")
    whole = marks.filter("place < 0").select(F.col("letters").alias("l"), F.col("hash").alias("h"), me)
    longer = cut.select((F.col("letters") - 1).alias("l"), F.col("hash").alias("h"), F.struct("crc", "whole", "letters").alias("b"))
    inserted = whole.join(longer, ["l", "h"]).select("a", "b")
    pairs = replaced.unionByName(inserted).unionByName(inserted.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    # a word's mark is its hash, checksum and length; the words themselves are joined for the exact test
    named = written(words.select("word").mapInArrow(_marks, "word string, crc long, whole long, letters int"), f"{purpose}-marks")
    name = lambda side, out: named.select(F.struct("crc", "whole", "letters").alias(side), F.col("word").alias(out))
    both = pairs.join(name("a", "word"), "a").join(name("b", "near"), "b")
    return both.filter((F.col("word") != F.col("near")) & (F.levenshtein("word", "near", 1) == 1)).select("word", "near")


def _marks(batches):
    for b in batches:
        words = b.column(0).to_pylist()
        hashes = []
        for w in words:
            h = 0
            for c in w:
                h = (h * BASE + ord(c)) % PRIME
            hashes.append(h)
        yield pa.record_batch([pa.array(words, pa.string()), pa.array([zlib.crc32(w.encode()) for w in words], pa.int64()),
                               pa.array(hashes, pa.int64()), pa.array(list(map(len, words)), pa.int32())], names=["word", "crc", "whole", "letters"])


def one_edit_pairs(words: DataFrame, max_depth: int = MAX_DEPTH, purpose: str = "spelling") -> DataFrame:
    """(word, near), both ways: words that differ by one inserted, deleted or replaced code point.

    ``words`` is a written table of distinct words of at least MIN_LETTERS code points.
    """
    letters = F.char_length("word")
    pairs = _trie_pairs(words.filter(letters <= max_depth), purpose)
    if words.filter(letters > max_depth).limit(1).count():
        pairs = pairs.unionByName(_long_pairs(words.filter(letters >= max_depth), purpose))
    return pairs.distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of written (word, form) rows by pointer doubling; counts grow along forms, so chains are short."""
    table = forms.select("word", F.col("form").alias("root"))
    while True:
        ahead = table.select(F.col("word").alias("w"), F.col("root").alias("r"))
        stepped = written(table.join(ahead, F.col("root") == F.col("w"), "left")
                          .select("word", F.coalesce("r", "root").alias("root"), F.col("r").isNotNull().alias("moved")), "spelling-roots")
        table = stepped.select("word", "root")
        if not stepped.filter("moved").limit(1).count():
            return table


def group_variants(docs: DataFrame, max_depth: int = MAX_DEPTH) -> DataFrame:
    """word, n, n_near, form, form_n, root."""
    words = written(word_counts(docs), "spelling-words")
    near = one_edit_pairs(words, max_depth)
    counts = words.select(F.col("word").alias("near"), F.col("n").alias("m"))
    best = (near.join(counts, "near").groupBy("word")
            .agg(F.count(F.lit(1)).alias("n_near"), F.min_by(F.struct("near", "m"), F.struct(-F.col("m"), F.col("near"))).alias("best")))
    strong = F.col("best.m") >= FORM_RATIO * F.col("n")
    rows = written(words.join(best, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                                                           F.when(strong, F.col("best.near")).alias("form"), F.when(strong, F.col("best.m")).alias("form_n")), "spelling-forms")
    roots = _roots(rows.filter(F.col("form").isNotNull()))
    return rows.join(roots, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
