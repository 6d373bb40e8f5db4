"""SimHash near duplicates by the general pigeonhole principle.

Fingerprints of 64 bits link at ``max_bits`` or fewer differing bits.  The bits are grouped into parts, bits
that agree or disagree together in the same part; every fingerprint then shares out ``max_bits`` over the
parts, unequally: part i gets a threshold t_i of -1 (not probed) or more with sum(t_i + 1) = max_bits + 1.  If
two fingerprints differ in at most max_bits bits, some part differs in at most its t_i bits whatever the
shares, so each fingerprint takes the shares with the fewest estimated candidates (dynamic programming over
parts).  Probes look up the part values within t_i bits; each candidate pair is verified on all 64 bits.

Only distinct fingerprints are compared: copies meet in one grouped minimum and are never paired.

Definitions: A-Z become a-z; words are runs of other characters than space and U+0009-U+000D; a text with fewer
words than a shingle is one shingle; a null text or one without words has fingerprint zero, linked like any
other.  Repeated rows share a fingerprint.  Rows with a null doc_id name no component: theirs is that of other
rows with linked fingerprints, else null (``component`` tells such groups apart).  An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hubflow.llm.common import written
from hubflow.operators.graph.contract import rekeyed, star_components

BITS, SEED = 64, 42
#: White space that parts words, and the only letters that are lower-cased.
SPACES = b" \t\n\r\x0b\x0c"
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
#: Widest piece of a part whose values are counted one by one.
COUNTED_BITS = 11


def fingerprint(text: str | None, words_per_shingle: int = 3) -> int:
    """Unsigned 64-bit fingerprint of a whole text; long texts are summed in slices."""
    import xxhash

    words = (text or "").encode().translate(LOWER).split()
    if not words:
        return 0
    k = min(words_per_shingle, len(words))
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = (ends - sizes).tolist()
    stops = ends.tolist()[k - 1:]
    digest, ones = xxhash.xxh64_intdigest, np.zeros(BITS, np.int64)
    for at in range(0, len(stops), 1 << 16):
        h = np.array([digest(joined[a:b], SEED) for a, b in zip(starts[at:at + (1 << 16)], stops[at:at + (1 << 16)])], "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return sum(1 << int(b) for b in np.flatnonzero(2 * ones > len(stops)))


def _fingerprints(words_per_shingle: int):
    def run(batches):
        for b in batches:
            fps = np.array([fingerprint(t, words_per_shingle) for t in b.column(2).to_pylist()], np.uint64)
            yield pa.record_batch([b.column(0), b.column(1), pa.array(fps.view(np.int64))], names=["doc_id", "text_key", "fp"])
    return run


def fingerprints(docs: DataFrame, words_per_shingle: int = 3) -> DataFrame:
    """doc_id, text_key (a hash that tells rows with equal doc_id apart), fp (signed 64 bits)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"),
                       F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_fingerprints(words_per_shingle), "doc_id long, text_key long, fp long")


def choose_parts(n: int, max_bits: int) -> int:
    """Number of parts with the fewest probes and candidates for n evenly spread fingerprints."""
    def cost(m: int) -> float:
        width = BITS // m
        shares = [(max_bits + 1) // m + (i < (max_bits + 1) % m) - 1 for i in range(m)]
        reach = [sum(math.comb(width, d) for d in range(t + 1)) for t in shares if t >= 0]
        return sum(r + r * n / 2.0 ** width for r in reach)
    return min(range(1, max_bits + 2), key=lambda m: (cost(m), m))


def _bit_sums(batches):
    both, n = np.zeros((BITS, BITS)), 0
    for b in batches:
        fps = b.column(0).to_numpy().astype("<i8")
        for at in range(0, len(fps), 50_000):
            x = np.unpackbits(fps[at:at + 50_000].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
            both += x.T @ x
            n += len(x)
    if n:
        i, j = np.indices((BITS, BITS)).reshape(2, -1)
        yield pa.record_batch([pa.array(np.append(i * BITS + j, -1)), pa.array(np.append(both.reshape(-1), n).astype(np.int64))],
                              names=["cell", "n"])


def group_bits(both: np.ndarray, n: int, parts: int) -> list[list[int]]:
    """Parts of near-equal width: each starts from the bit most correlated with the rest and takes in, one by
    one, the free bit most correlated with its members."""
    p = np.diag(both) / max(n, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-9))
    corr = np.abs((both / max(n, 1) - np.outer(p, p)) / np.outer(spread, spread))
    free, groups = list(range(BITS)), []
    for g in range(parts):
        width = BITS // parts + (g < BITS % parts)
        group: list[int] = []
        while len(group) < width:
            among = group or free
            best = max(free, key=lambda b: (corr[b, among].sum() - (0 if group else corr[b, b]), -b))
            group.append(best)
            free.remove(best)
        groups.append(sorted(group))
    return groups


def _pick(fps: np.ndarray, bits: list[int]) -> np.ndarray:
    """The given bits of each fingerprint, packed from bit 0 on."""
    out = np.zeros(len(fps), np.uint64)
    for k, b in enumerate(bits):
        out |= (fps >> np.uint64(b) & np.uint64(1)) << np.uint64(k)
    return out


def _pieces(bits: list[int]) -> list[list[int]]:
    count = -(-len(bits) // COUNTED_BITS)
    return [bits[i * len(bits) // count:(i + 1) * len(bits) // count] for i in range(count)]


def _value_counts(groups: list[list[int]]):
    def run(batches):
        counts = {}
        for b in batches:
            fps = b.column(0).to_numpy().astype(np.int64).view(np.uint64)
            for g, bits in enumerate(groups):
                for s, piece in enumerate(_pieces(bits)):
                    c = np.bincount(_pick(fps, piece).astype(np.int64), minlength=1 << len(piece))
                    counts[g, s] = counts.get((g, s), 0) + c
        for (g, s), c in counts.items():
            at = np.flatnonzero(c)
            yield pa.record_batch([pa.array(np.full(len(at), g)), pa.array(np.full(len(at), s)), pa.array(at), pa.array(c[at])],
                                  names=["g", "s", "v", "n"])
    return run


def near_shares(share: np.ndarray, width: int, most: int) -> np.ndarray:
    """[d, v]: share of values at exactly d bits from v, for d up to ``most``."""
    out = [share]
    v = np.arange(len(share))
    for d in range(1, most + 1):
        step = sum(out[d - 1][v ^ (1 << b)] for b in range(width)) if width else np.zeros_like(share)
        back = (width - d + 2) * out[d - 2] if d >= 2 else 0
        out.append((step - back) / d)
    return np.maximum(np.stack(out), 0)


def shares_of(fps: np.ndarray, groups: list[list[int]], tables: dict, n: int, max_bits: int) -> np.ndarray:
    """Thresholds [fingerprint, part] with the fewest estimated candidates and probes."""
    budget = max_bits + 1
    cost = np.zeros((len(groups), budget + 1, len(fps)))
    for g, bits in enumerate(groups):
        exact = np.zeros((budget, len(fps)))
        exact[0] = 1
        for s, piece in enumerate(_pieces(bits)):
            near = tables[g, s][:, _pick(fps, piece).astype(np.int64)]
            exact = np.stack([sum(exact[a] * near[d - a] for a in range(d + 1)) for d in range(budget)])
        probes = np.cumsum([math.comb(len(bits), d) for d in range(budget)])
        cost[g, 1:] = n * np.cumsum(exact, axis=0) + probes[:, None]
    best = np.full((budget + 1, len(fps)), np.inf)
    best[0] = 0
    taken = np.zeros((len(groups), budget + 1, len(fps)), np.int8)
    for g in range(len(groups)):
        options = np.stack([np.stack([best[e - x] + cost[g, x] if x <= e else np.full(len(fps), np.inf)
                                      for x in range(budget + 1)]) for e in range(budget + 1)])
        taken[g] = options.argmin(axis=1)
        best = options.min(axis=1)
    left = np.full(len(fps), budget)
    out = np.zeros((len(fps), len(groups)), np.int8)
    for g in range(len(groups) - 1, -1, -1):
        x = taken[g, left, np.arange(len(fps))]
        out[:, g] = x - 1
        left = left - x
    return out


def _entries(groups: list[list[int]]):
    """Index rows: every part's value of every fingerprint."""
    def run(batches):
        for b in batches:
            fps = b.column(0).to_numpy().astype(np.int64)
            for g, bits in enumerate(groups):
                yield pa.record_batch([pa.array(np.full(len(fps), g, np.int32)), pa.array(_pick(fps.view(np.uint64), bits).view(np.int64)),
                                       pa.array(fps)], names=["part", "value", "fp"])
    return run


def _probes(groups: list[list[int]], tables: dict, n: int, max_bits: int):
    """Probe rows: for each part, the values within the fingerprint's threshold there."""
    flips = [[np.array([sum(1 << b for b in c) for c in itertools.combinations(range(len(bits)), d)], np.uint64)
              for d in range(max_bits + 1)] for bits in groups]

    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, 4096):
                fps = b.column(0).to_numpy()[at:at + 4096].astype(np.int64)
                shares = shares_of(fps.view(np.uint64), groups, tables, n, max_bits)
                for g, bits in enumerate(groups):
                    value = _pick(fps.view(np.uint64), bits)
                    for d in range(max_bits + 1):
                        rows = np.flatnonzero(shares[:, g] >= d)
                        for some in np.array_split(rows, max(1, len(rows) * len(flips[g][d]) >> 18)):
                            near = (value[some, None] ^ flips[g][d][None, :]).reshape(-1)
                            k = len(flips[g][d])
                            yield pa.record_batch([pa.array(np.full(len(near), g, np.int32)), pa.array(near.view(np.int64)),
                                                   pa.array(np.repeat(fps[some], k))], names=["part", "value", "fp"])
    return run


def fingerprint_links(classes: DataFrame, max_bits: int = 2) -> DataFrame:
    """(u, v): pairs of fingerprints that differ in at most max_bits bits, each pair once.

    ``classes`` is a written table of distinct ``fp``.
    """
    spark = classes.sparkSession
    sums = {r["cell"]: r["n"] for r in classes.select("fp").mapInArrow(_bit_sums, "cell long, n long")
            .groupBy("cell").agg(F.sum("n").alias("n")).collect()}  # 64 x 64 counts and the total
    n = sums.pop(-1, 0)
    both = np.zeros(BITS * BITS)
    for cell, c in sums.items():
        both[cell] = c
    groups = group_bits(both.reshape(BITS, BITS), n, choose_parts(n, max_bits))
    tables = {(g, s): np.zeros(1 << len(p)) for g, bits in enumerate(groups) for s, p in enumerate(_pieces(bits))}
    for r in (classes.select("fp").mapInArrow(_value_counts(groups), "g long, s long, v long, n long")
              .groupBy("g", "s", "v").agg(F.sum("n").alias("n")).collect()):  # at most 2^11 values for each piece of 64 bits
        tables[r["g"], r["s"]][r["v"]] = r["n"] / n
    near = {k: near_shares(t, int(math.log2(len(t))), max_bits) for k, t in tables.items()}
    shared = spark.sparkContext.broadcast(near)
    kind = "part int, value long, fp long"
    rows = classes.select("fp")
    index = rows.mapInArrow(_entries(groups), kind).select("part", "value", F.col("fp").alias("fp2"))

    def probing(batches):
        yield from _probes(groups, shared.value, n, max_bits)(batches)

    pairs = (rows.mapInArrow(probing, kind).join(index, ["part", "value"])
             .filter((F.col("fp") < F.col("fp2")) & (F.bit_count(F.col("fp").bitwiseXOR(F.col("fp2"))) <= max_bits)))
    return pairs.select(F.col("fp").alias("u"), F.col("fp2").alias("v")).distinct()


def simhash_components(docs: DataFrame, words_per_shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """doc_id, text_key, fp, component (its smallest signed fingerprint), component_id (its smallest doc_id)."""
    prints = written(fingerprints(docs, words_per_shingle), "simhash")
    classes = written(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-classes")
    found = star_components(fingerprint_links(classes, max_bits))
    grouped = written(classes.join(found, F.col("fp") == F.col("node"), "left")
                      .select("fp", "least", F.coalesce("component", "fp").alias("component")), "simhash-groups")
    names = grouped.groupBy("component").agg(F.min("least").alias("component_id"))
    names = names.select(rekeyed(names, "component").alias("named"), "component_id")
    labelled = written(grouped.join(names, F.col("component") == F.col("named"))
                       .select(F.col("fp").alias("class"), "component", "component_id"), "simhash-labels")
    return prints.join(labelled, F.col("fp") == F.col("class")).select("doc_id", "text_key", "fp", "component", "component_id")
