"""Embedding near duplicates by counting collisions on one-dimensional projections.

Every unit vector is projected on ``projections`` Gaussian directions.  Two vectors collide on a direction when
the candidate lies in the window around the query's value there.  For a pair at the cosine threshold the
differences are independent normal variables of known spread, so the number of collisions is binomial: the
window and the count that a pair must reach are set so that a pair at the threshold passes with probability
``recall`` (closer pairs more often), and pairs that pass are verified by their cosine in double precision.

Work is dealt in tiles: the vectors of a label, sorted by their first projection, form blocks of bounded size, and
each pair of blocks whose projections can hold a link is one task's work.  A tile sorts the candidates on every
direction, adds one to each (query, candidate) within the query's window, and returns link counts for each vector
and at most one edge for each vector (a spanning star of each group it finds), never all pairs.

Definitions: only rows with equal, non-null labels (and equal dimension) are compared; vectors that are null,
empty, zero or hold null or non-finite components link with nothing; copies (equal label and components) form
one class, which counts its copies as links; a row with a null vec_id names no component; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hubflow.llm.common import parallelism, written
from hubflow.operators.graph.contract import rekeyed, star_components

#: Vectors in a block, and half the width of a window in standard deviations at the threshold.
BLOCK, WINDOW = 2_048, 2.5


def directions(dim: int, projections: int, seed: int = 42) -> np.ndarray:
    return np.random.default_rng([seed, dim]).standard_normal((dim, projections))


def calibrate(threshold: float, projections: int, recall: float) -> tuple[float, int]:
    """(half width of a window, collisions needed) so that a pair at the threshold passes at ``recall``."""
    spread = math.sqrt(2 - 2 * threshold)
    p = math.erf(WINDOW / math.sqrt(2))
    tail, need = 0.0, projections + 1
    while tail < recall and need:
        need -= 1
        tail += math.comb(projections, need) * p ** need * (1 - p) ** (projections - need)
    return WINDOW * spread, need


def _unit(raw: list, dim: int) -> np.ndarray:
    x = np.array(raw, np.float64).reshape(-1, dim)
    return x / np.linalg.norm(x / np.abs(x).max(axis=1, keepdims=True), axis=1, keepdims=True) / np.abs(x).max(axis=1, keepdims=True)


def _project(projections: int):
    names = ["label", "dim", "first", "rep", "copies", "unit"]

    def run(batches):
        for b in batches:
            label, rep, copies = (b.column(i).to_pylist() for i in range(3))
            vectors = b.column(3).to_pylist()
            for dim in sorted({len(v) for v in vectors}):
                at = [i for i, v in enumerate(vectors) if len(v) == dim]
                unit = _unit([vectors[i] for i in at], dim)
                first = unit @ directions(dim, projections)[:, 0]
                yield pa.record_batch([pa.array([label[i] for i in at], pa.int64()), pa.array([dim] * len(at), pa.int32()),
                                       pa.array(first), pa.array([rep[i] for i in at], pa.int64()),
                                       pa.array([copies[i] for i in at], pa.int64()), pa.array([u.tobytes() for u in unit])], names=names)
    return run


def _blocks(projections: int):
    """Sorted rows -> blocks of at most BLOCK rows of one label and dimension, with the bounds of every projection."""
    names = ["label", "dim", "block", "low", "high", "reps", "copies", "units"]

    def run(batches):
        from pyspark import TaskContext

        part, number, held = TaskContext.get().partitionId(), 0, []

        def block():
            nonlocal number
            label, dim = held[0][:2]
            units = b"".join(r[5] for r in held)
            values = np.frombuffer(units).reshape(-1, dim) @ directions(dim, projections)
            number += 1
            return pa.record_batch([pa.array([label], pa.int64()), pa.array([dim], pa.int32()), pa.array([(part << 32) + number]),
                                    pa.array([values.min(axis=0)]), pa.array([values.max(axis=0)]),
                                    pa.array([np.array([r[3] for r in held], "<i8").tobytes()]),
                                    pa.array([np.array([r[4] for r in held], "<i8").tobytes()]), pa.array([units])], names=names)

        for b in batches:
            for row in zip(*(b.column(i).to_pylist() for i in range(6))):
                if held and (held[0][:2] != row[:2] or len(held) == BLOCK):
                    yield block()
                    held = []
                held.append(row)
        if held:
            yield block()
    return run


def collisions(queries: np.ndarray, candidates: np.ndarray, half: float) -> np.ndarray:
    """[query, candidate] number of directions on which the candidate lies in the query's window."""
    counts = np.zeros((len(queries), len(candidates)), np.uint8)
    for k in range(queries.shape[1]):
        order = np.argsort(candidates[:, k], kind="stable")
        line = candidates[order, k]
        low = np.searchsorted(line, queries[:, k] - half, side="left").tolist()
        high = np.searchsorted(line, queries[:, k] + half, side="right").tolist()
        for row, a, z in zip(counts, low, high):
            row[order[a:z]] += 1
    return counts


def tile_links(a: np.ndarray, b: np.ndarray, same: bool, threshold: float, half: float, need: int, projections: int):
    """Index pairs (i, j) of unit rows that pass the count and the cosine; i < j within one block."""
    pa_, pb = a @ directions(a.shape[1], projections), b @ directions(b.shape[1], projections)
    for at in range(0, len(a), 512):
        i, j = np.nonzero(collisions(pa_[at:at + 512], pb, half) >= need)
        i = i + at
        if same:
            i, j = i[i < j], j[i < j]
        for s in range(0, len(i), 1 << 17):
            x, y = i[s:s + (1 << 17)], j[s:s + (1 << 17)]
            ok = np.einsum("ij,ij->i", a[x], b[y]) >= threshold
            yield x[ok], y[ok]


def _tiles(threshold: float, projections: int, half: float, need: int):
    names = ["u", "v", "n"]

    def run(batches):
        for b in batches:
            for dim, ra, ca, ua, rb, cb, ub, same in zip(*(b.column(i).to_pylist() for i in range(8))):
                reps, copies = [np.frombuffer(x, "<i8") for x in (ra, rb)], [np.frombuffer(x, "<i8") for x in (ca, cb)]
                x, y = (np.frombuffer(u).reshape(-1, dim) for u in (ua, ub))
                base = 0 if same else len(x)
                all_reps = reps[0] if same else np.concatenate(reps)
                links, group = np.zeros(len(all_reps), np.int64), np.arange(len(all_reps))
                pairs = []
                for i, j in tile_links(x, y, same, threshold, half, need, projections):
                    np.add.at(links, i, copies[1][j])
                    np.add.at(links, base + j, copies[0][i])
                    pairs.append((i, base + j))
                while pairs:  # smallest index over links until none changes
                    before = group.copy()
                    for i, j in pairs:
                        low = np.minimum(group[i], group[j])
                        np.minimum.at(group, i, low)
                        np.minimum.at(group, j, low)
                    group = group[group]
                    if (group == before).all():
                        break
                met = np.flatnonzero(links)
                yield pa.record_batch([pa.array(all_reps[met]), pa.array(all_reps[group[met]]), pa.array(links[met])], names=names)
    return run


def link_vectors(embeddings: DataFrame, threshold: float = 0.93, projections: int = 32, recall: float = 0.99999) -> DataFrame:
    """vec_id, n_links, component_id (smallest vec_id reachable), kept, for every row."""
    spark = embeddings.sparkSession
    fine = (F.col("label").isNotNull() & F.exists("embedding", lambda x: x != 0)
            & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    rows = (embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), "embedding")
            .withColumn("fine", F.coalesce(fine, F.lit(False))))
    classes = written(rows.filter("fine").groupBy("label", "embedding")
                      .agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("copies"))
                      .withColumn("rep", F.monotonically_increasing_id()), "vector-classes")
    half, need = calibrate(threshold, projections, recall)
    n = classes.count()
    lined = (classes.select("label", "rep", "copies", "embedding")
             .mapInArrow(_project(projections), "label long, dim int, first double, rep long, copies long, unit binary"))
    parts = max(1, min(parallelism(spark), n // (BLOCK // 2)), n // (4 * BLOCK))
    blocks = written(lined.repartitionByRange(parts, "label", "dim", "first").sortWithinPartitions("label", "dim", "first", "rep")
                     .mapInArrow(_blocks(projections), "label long, dim int, block long, low array<double>, high array<double>, "
                                                       "reps binary, copies binary, units binary"), "vector-blocks")
    # |a.(x - y)| <= |a| |x - y| on every direction: blocks further apart than that hold no link
    spread = math.sqrt(2 - 2 * threshold)
    box = blocks.select("label", "dim", "block", "low", "high")
    dims = [r["dim"] for r in blocks.select("dim").distinct().collect()]
    reach = {d: [float(spread * x * (1 + 1e-9)) for x in np.linalg.norm(directions(d, projections), axis=0)] for d in dims}
    bound = F.create_map(*[x for d in dims for x in (F.lit(d), F.array(*map(F.lit, reach[d])))]) if dims else None
    a, b = box.alias("a"), box.alias("b")
    near = (F.col("a.label") == F.col("b.label")) & (F.col("a.dim") == F.col("b.dim")) & (F.col("a.block") <= F.col("b.block"))
    tiles = a.join(b, near)
    if bound is not None:
        gap = F.zip_with(F.zip_with("b.low", "a.high", lambda p, q: p - q), F.zip_with("a.low", "b.high", lambda p, q: p - q),
                         lambda p, q: F.greatest(p, q))
        tiles = tiles.filter(F.forall(F.zip_with(gap, bound[F.col("a.dim")], lambda g, r: g <= r), lambda ok: ok))
    tiles = tiles.select(F.col("a.block").alias("block_a"), F.col("b.block").alias("block_b"))
    left = blocks.select(F.col("block").alias("block_a"), "dim", F.col("reps").alias("ra"), F.col("copies").alias("ca"), F.col("units").alias("ua"))
    right = blocks.select(F.col("block").alias("block_b"), F.col("reps").alias("rb"), F.col("copies").alias("cb"), F.col("units").alias("ub"))
    dealt = (tiles.join(left, "block_a").join(right, "block_b").withColumn("same", F.col("block_a") == F.col("block_b"))
             .select("dim", "ra", "ca", "ua", "rb", "cb", "ub", "same").repartition(max(parallelism(spark), 4 * parts)))
    found = written(dealt.mapInArrow(_tiles(threshold, projections, half, need), "u long, v long, n long"), "vector-links")
    links = found.groupBy("u").agg(F.sum("n").alias("n"))
    components = star_components(found.select("u", "v"))
    grouped = written(classes.join(links, F.col("rep") == F.col("u"), "left").join(components, F.col("rep") == F.col("node"), "left")
                      .select("label", "embedding", "least", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("links"),
                              F.coalesce("component", "rep").alias("group")), "vector-groups")
    names = grouped.groupBy("group").agg(F.min("least").alias("component"))
    names = names.select(rekeyed(names, "group").alias("named"), "component")
    labelled = written(grouped.join(names, F.col("group") == F.col("named"))
                       .select(F.col("label").alias("l"), F.col("embedding").alias("e"), "links", "component"), "vector-labels")
    out = rows.join(labelled, F.col("fine") & (F.col("label") == F.col("l")) & (F.col("embedding") == F.col("e")), "left")
    component = F.when(F.col("l").isNull(), F.col("vec_id")).otherwise(F.col("component"))
    return out.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                      F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
