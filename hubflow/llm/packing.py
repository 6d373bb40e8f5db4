"""Best-fit packing of token pieces into fixed-length sequences by bin completion.

Only the histogram of piece lengths (at most ``capacity`` rows) decides the packing, so the branch and bound
runs on counts: a filling chosen once is used as often as the counts allow.  Spark then deals every piece,
by its rank among pieces of its length, to its place in a filling.

Definitions: a null text is an empty one; each document ends with the end id, so none is empty; rows with
equal doc_id are packed each; a null doc_id is kept; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hubflow.llm.common import gapless_rank, written
from hubflow.llm.tokenization import encoded

#: Nodes that the search may open, and fillings that it tries at a node.  They bound time, never rows:
#: the incumbent is always a packing of every piece.
NODES, BRANCHES = 3_000, 4


def lower_bound(count: np.ndarray, capacity: int) -> int:
    """Sequences that any packing needs: the best over k of items above capacity - k standing alone,
    middle ones apart, and what of the smaller ones (at least k) does not fit beside the middle ones."""
    size = np.arange(capacity + 1, dtype=np.int64)
    n, s = np.concatenate([[0], np.cumsum(count)]), np.concatenate([[0], np.cumsum(count * size)])
    half, best = capacity // 2, 0
    for k in range(1, half + 1):
        large = n[capacity + 1] - n[capacity - k + 1]
        middle = n[capacity - k + 1] - n[half + 1]
        room = middle * capacity - (s[capacity - k + 1] - s[half + 1])
        left = s[half + 1] - s[k]
        best = max(best, int(large + middle + max(0, -(-(left - room) // capacity))))
    return max(best, -(-int(s[-1]) // capacity))


def completions(count: np.ndarray, room: int, most: int = BRANCHES) -> list[tuple[int, ...]]:
    """Undominated fillings of ``room`` by available sizes, least waste first, larger items first.

    A filling is dominated if one available item could stand in for part of it without loss of room: hence
    an item of exactly ``room`` is the only one, and items are taken in descending order.
    """
    if room and count[room]:
        return [(room,)]
    have = np.flatnonzero(count[:room + 1])[::-1].tolist()
    if not have:
        return [()]
    smallest, found, steps = have[-1], [], [0]
    left = {s: int(count[s]) for s in have}
    prefix = np.cumsum([s * left[s] for s in reversed(have)])[::-1].tolist()  # what sizes from here on sum to
    waste = [room + 1]

    def descend(at: int, room: int, taken: tuple[int, ...]) -> None:
        steps[0] += 1
        if steps[0] > 400:
            return
        if room < smallest or at == len(have):
            found.append((room, taken))
            waste[0] = min(waste[0], room)
            return
        closed = True
        while at < len(have) and have[at] > room:
            at += 1
        for k in range(at, len(have)):
            s = have[k]
            if not left[s]:
                continue
            if prefix[k] < room - waste[0] or waste[0] == 0 and len(found) >= most:
                break
            closed = False
            left[s] -= 1
            if room - s and s >= room - s and left.get(room - s):
                found.append((0, (*taken, s, room - s)))
                waste[0] = 0
            else:
                descend(k, room - s, (*taken, s))
            left[s] += 1
        if closed:
            found.append((room, taken))
            waste[0] = min(waste[0], room)

    descend(0, room, ())
    found = sorted(set(found), key=lambda f: (f[0], tuple(-x for x in f[1])))
    kept: list[tuple[int, tuple[int, ...]]] = []
    for rest, taken in found:  # one item in place of another that leaves no more room dominates
        if not any(len(t) == len(taken) and all(a >= b for a, b in zip(t, taken)) for _, t in kept):
            kept.append((rest, taken))
        if len(kept) == most:
            break
    return [t for _, t in kept]


def _times(count: np.ndarray, filling: tuple[int, ...]) -> int:
    sizes, need = np.unique(filling, return_counts=True)
    return int((count[sizes] // need).min())


def _best_fit(count: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """The first incumbent: the largest item, then again and again the largest that still fits."""
    count, out = count.copy(), []
    for s in range(capacity, 0, -1):
        while count[s]:
            filling, room = [s], capacity - s
            count[s] -= 1
            while room and (fit := np.flatnonzero(count[:room + 1])).size:
                x = int(fit[-1])
                filling.append(x)
                count[x] -= 1
                room -= x
            np.add.at(count, filling, 1)
            times = _times(count, tuple(filling))
            np.subtract.at(count, filling, times)
            out.append((tuple(filling), times))
    return out


def plan_packing(histogram: dict[int, int], capacity: int, nodes: int = NODES) -> list[tuple[tuple[int, ...], int]]:
    """[(lengths in a sequence, number of such sequences)] that uses every piece exactly once."""
    count = np.zeros(capacity + 1, np.int64)
    for s, n in histogram.items():
        count[s] += n
    best = _best_fit(count, capacity)
    least, used = lower_bound(count, capacity), sum(t for _, t in best)
    size = np.arange(capacity + 1)
    waste_allowed = lambda bins: bins * capacity - int((count * size).sum())
    # Depth first over (counts, fillings so far, sequences so far, waste so far); the first dive takes the first filling each time.
    stack: list[tuple[np.ndarray, list, int, int]] = [(count, [], 0, 0)]
    while stack and used > least and nodes > 0:
        now, path, bins, waste = stack.pop()
        nodes -= 1
        large = np.flatnonzero(now)
        if not large.size:
            if bins < used:
                best, used = path, bins
            continue
        if waste > waste_allowed(used - 1) or bins + -(-int((now * size).sum()) // capacity) >= used:
            continue
        top = int(large[-1])
        now[top] -= 1
        options = completions(now, capacity - top)
        now[top] += 1
        children = []
        for rest in options:
            filling = (top, *rest)
            times = _times(now, filling)
            after = now.copy()
            np.subtract.at(after, list(filling), times)
            lost = (capacity - sum(filling)) * times
            children.append((after, [*path, (filling, times)], bins + times, waste + lost))
        stack.extend(reversed(children))
    return best


def _cut(path: str, end_id: int, capacity: int, with_ids: bool):
    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()] + [pa.binary()] * with_ids

    def run(batches):
        for b in batches:
            keys, out = b.column(0).to_pylist(), []
            for i, ids in encoded(path, b.column(1), end_id):
                wide = ids.astype("<u4")
                first = len(wide) % capacity or capacity
                for piece, stop in enumerate(range(first, len(wide) + 1, capacity)):
                    start = max(0, stop - capacity) if piece else 0
                    raw = wide[start:stop].tobytes()
                    out.append((keys[i], piece, start, stop - start, zlib.crc32(raw), *[raw] * with_ids))
            if out:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=names)
    return run


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = 2, with_ids: bool = False) -> DataFrame:
    """One row per piece; a document longer than ``capacity`` is cut, its first piece may be shorter."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    kind = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    return rows.mapInArrow(_cut(tokenizer, end_id, capacity, with_ids), kind)


def _place(plan: list[tuple[tuple[int, ...], int]]):
    """Tables that say, for the rank-th piece of a length, its sequence and its offset there."""
    keys, bases, firsts, copies, offsets, lengths = [], [], [], [], [], []
    used: dict[int, int] = {}
    base = 0
    for filling, times in plan:
        at = 0
        for s in sorted(set(filling), reverse=True):
            k = filling.count(s)
            first = used.get(s, 0)
            keys.append((s << 44) + first)
            bases.append(base), firsts.append(first), copies.append(k), offsets.append(at), lengths.append(s)
            used[s] = first + k * times
            at += k * s
        base += times
    order = np.argsort(np.array(keys, np.int64))
    table = [np.array(x, np.int64)[order] for x in (keys, bases, firsts, copies, offsets)]

    def run(batches):
        key, base, first, copy, offset = table
        for b in batches:
            length, rank = (b.column(b.schema.get_field_index(c)).to_numpy() for c in ("length", "_rank"))
            at = np.searchsorted(key, (length << 44) + rank, side="right") - 1
            nth = rank - first[at]
            kept = [b.column(i) for i, c in enumerate(b.schema.names) if c != "_rank"]
            names = [c for c in b.schema.names if c != "_rank"]
            yield pa.record_batch([*kept, pa.array(base[at] + nth // copy[at], pa.int64()),
                                   pa.array(offset[at] + nth % copy[at] * length, pa.int64())], names=[*names, "sequence_id", "offset"])
    return run


def pack_pieces(pieces: DataFrame, capacity: int = 1024) -> DataFrame:
    """Adds sequence_id and offset to a written table of pieces with a ``length`` of 1 to ``capacity``."""
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    plan = plan_packing(histogram, capacity)
    ranked = gapless_rank(pieces, ["length"], ["doc_id", "piece"], "_rank")
    kinds = ", ".join(f"{c} {t}" for c, t in pieces.dtypes)
    return ranked.mapInArrow(_place(plan), f"{kinds}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = 2, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32[, ids], sequence_id, offset for every piece of ``documents``."""
    return pack_pieces(written(token_pieces(docs, tokenizer, capacity, end_id, with_ids), "pieces"), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id and its tokens (at most ``capacity``), from pieces packed with their ids (<u4 bytes)."""
    rows = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("p"))
    return rows.select("sequence_id", F.aggregate("p", F.lit(b""), lambda a, x: F.concat(a, x["ids"])).alias("ids"))
