"""Resharding by minimum-cost flow: which blocks of old shards go to which new shards.

Old shards are supplies of bytes, new shards are capacities, and a byte costs what its move costs (nothing
if it stays).  The flow is solved exactly on shards; each old shard then meets its outgoing flows with
whole blocks.  A block is a document of more than a thousandth of a mean shard, or a hash class of the others
(``BLOCKS`` to a shard): so the block list that the driver sees is bounded by the shards, whatever the data.

Only shards that give blocks away are rewritten: their staying and leaving documents go to a new folder, while
the files of shards that only receive stay as they are.

Definitions: a null text has no bytes, each document counts one byte more; null doc_ids are one key and share
a block; rows with equal doc_id and equal text move together if small; an empty table gives no rows; extra
columns are kept unless they are named like the layout's own (shard, size, block), which win.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hubflow.llm.common import gapless_rank, work_dir, written

#: Hash classes of small documents in each old shard; documents above 1/BLOCKS of a mean shard stand alone.
BLOCKS = 1_000


def min_cost_flow(supply: list[int], capacity: list[int], cost: list[list[int]]) -> list[list[int]]:
    """flow[i][j] of least total cost that ships every supply within the capacities (sums may differ).

    Successive shortest paths with potentials over the bipartite graph of old and new shards.
    """
    n, m = len(supply), len(capacity)
    if sum(supply) > sum(capacity):
        raise ValueError("capacities are too small")
    flow = [[0] * m for _ in range(n)]
    left, room = list(supply), list(capacity)
    price = [0] * (n + m)
    for source in sorted(range(n), key=lambda i: -left[i]):
        while left[source]:
            far, back = {source: 0}, {}
            queue, done = [(0, source)], set()
            while queue:
                d, x = heapq.heappop(queue)
                if x in done:
                    continue
                done.add(x)
                if x < n:
                    arcs = ((n + j, cost[x][j]) for j in range(m))
                else:
                    arcs = ((i, -cost[i][x - n]) for i in range(n) if flow[i][x - n])
                for y, c in arcs:
                    e = d + c + price[x] - price[y]
                    if y not in done and e < far.get(y, e + 1):
                        far[y], back[y] = e, x
                        heapq.heappush(queue, (e, y))
            end = min((x for x in done if x >= n and room[x - n]), key=lambda x: (far[x] + price[x] - price[source], x))
            for x in range(n + m):
                price[x] += min(far.get(x, far[end]), far[end])
            path, x = [], end
            while x != source:
                path.append((back[x], x))
                x = back[x]
            amount = min(left[source], room[end - n], *(flow[y][x - n] for x, y in path if x >= n))
            for x, y in path:
                if x < n:
                    flow[x][y - n] += amount
                else:
                    flow[y][x - n] -= amount
            left[source] -= amount
            room[end - n] -= amount
    return flow


def place_blocks(blocks: list[tuple[int, int, int]], flow: list[list[int]], capacity: list[int]) -> list[int]:
    """New shard of each (old shard, block, bytes): large blocks first, each to the arc with the most flow left;
    then single blocks move between the fullest and the emptiest shard while that evens them out."""
    left = [list(row) for row in flow]
    order = sorted(range(len(blocks)), key=lambda b: (-blocks[b][2], blocks[b]))
    new, load = [0] * len(blocks), [0] * len(capacity)
    for b in order:
        i, _, size = blocks[b]
        j = max(range(len(capacity)), key=lambda j: (left[i][j], j == i, -j))
        left[i][j] -= size
        load[j] += size
        new[b] = j
    members: list[set[int]] = [set() for _ in capacity]
    for b, j in enumerate(new):
        members[j].add(b)
    over = lambda j: load[j] - capacity[j]
    while len(capacity) > 1:
        a, z = max(range(len(capacity)), key=lambda j: (over(j), -j)), min(range(len(capacity)), key=lambda j: (over(j), j))
        gap = over(a) - over(z)
        fits = [b for b in members[a] if 0 < blocks[b][2] < gap]
        if not fits:
            break
        b = min(fits, key=lambda b: (abs(2 * blocks[b][2] - gap), blocks[b][0] == a, blocks[b]))
        members[a].remove(b), members[z].add(b)
        load[a] -= blocks[b][2]
        load[z] += blocks[b][2]
        new[b] = z
    return new


def sized(docs: DataFrame) -> DataFrame:
    """Adds ``size`` (UTF-8 bytes of the text plus one)."""
    return docs.withColumn("size", (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long"))


def write_layout(docs: DataFrame, folder: str) -> None:
    """Documents with ``shard`` as files of one folder per shard; no shuffle: each task adds a file to each."""
    docs.write.option("compression", "zstd").partitionBy("shard").parquet(folder)


def read_layout(spark: SparkSession, folder: str, schema) -> DataFrame:
    return spark.read.schema(schema).parquet(folder)


def plan_resharding(layout: DataFrame, shards: int, cost=None) -> tuple[DataFrame, int]:
    """((shard, block, new_shard), size above which a document is a block) for the blocks of a layout with doc_id, size, shard; near-equal new shards.

    ``cost(old, new)`` prices a byte's move; by default moves cost 1 and staying costs 0.
    """
    spark = layout.sparkSession
    total = layout.agg(F.sum("size")).first()[0] or 0
    alone = max(1, total // max(1, shards * BLOCKS))
    keyed = with_block(layout, alone)
    blocks = [tuple(r) for r in keyed.groupBy("shard", "block").agg(F.sum("size").alias("bytes")).collect()]
    old = 1 + max([shards - 1, *(b[0] for b in blocks)])
    supply = [0] * old
    for i, _, size in blocks:
        supply[i] += size
    capacity = [total // shards + (j < total % shards) for j in range(shards)]
    price = cost or (lambda i, j: int(i != j))
    flow = min_cost_flow(supply, capacity, [[price(i, j) for j in range(shards)] for i in range(old)])
    new = place_blocks(blocks, flow, capacity)
    rows = [(i, b, alone, j) for (i, b, _), j in zip(blocks, new)]
    return spark.createDataFrame(rows, "shard int, block long, alone long, new_shard int"), alone


def with_block(layout: DataFrame, alone: int) -> DataFrame:
    """Documents above ``alone`` bytes are blocks of their own (negative hash), others share BLOCKS classes.

    A layout's ``mark``, if it has one, tells rows with equal or no doc_id apart, so that many of them are many blocks.
    """
    h = F.xxhash64("doc_id", "size", *["mark"] * ("mark" in layout.columns))
    return layout.withColumn("block", F.when(F.col("size") > alone, -(F.shiftrightunsigned(h, 1)) - 1)
                             .otherwise(F.pmod(h, F.lit(BLOCKS)).cast("long")))


def reshard(spark: SparkSession, folder: str, schema, shards: int, cost=None) -> DataFrame:
    """Evens out a layout written by ``write_layout``: plans, rewrites the shards that give, returns the new
    layout (``shard`` is the new one, ``old_shard`` the one before)."""
    old = read_layout(spark, folder, schema)
    plan, alone = plan_resharding(old.drop("text"), shards, cost)
    plan = F.broadcast(plan)  # at most shards * BLOCKS classes and as many documents above a thousandth of a shard
    givers = [r[0] for r in plan.filter("shard <> new_shard").select("shard").distinct().orderBy("shard").collect()]
    giving = F.col("shard").isin(givers)
    names = [c for c in old.columns if c != "shard"]
    moved = (with_block(old.filter(giving), alone).join(plan.drop("alone"), ["shard", "block"])
             .select(*names, F.col("shard").alias("old_shard"), F.col("new_shard").alias("shard")))
    fresh = f"{folder}-rewritten"
    write_layout(moved, fresh)
    rewritten = spark.read.schema(moved.schema).parquet(fresh)
    kept = old.filter(~giving).select(*names, F.col("shard").alias("old_shard"), "shard")
    return kept.unionByName(rewritten)


def shard_documents(docs: DataFrame, shards: int = 16, old_shards: int = 16) -> DataFrame:
    """Old layout by a hash of ``source`` (so a hot source makes a hot shard), then resharded by flow.

    Returns doc_id, size, text_crc32, shard, slot (gapless within the shard), old_shard.
    """
    spark = docs.sparkSession
    first = sized(docs.select("doc_id", "text", "source")).withColumn(
        "shard", F.pmod(F.xxhash64("source"), F.lit(old_shards)).cast("int")).withColumn("mark", F.monotonically_increasing_id())
    folder = work_dir(spark, "shards")
    write_layout(first, folder)
    layout = reshard(spark, folder, first.schema, shards)
    digest = layout.select("doc_id", "size", F.crc32(F.encode(F.coalesce("text", F.lit("")), "UTF-8")).alias("text_crc32"),
                           "shard", "old_shard")
    return gapless_rank(written(digest, "shard-digest"), ["shard"], ["doc_id", "text_crc32", "size"], "slot")
