"""Resharding as a minimum-cost flow.

Old shards send their bytes to new shards of given capacities. Bytes that stay where they are cost nothing, moved bytes
cost one each, and moves go through one hub node, so the network has as many arcs as there are shards. Shortest paths, all of
one length at a time, solve it on the driver, which sees only the shard sizes. The flow is then cut out of the rows: an old shard
is a line of bytes in the order of its row hash, each block transfer is an interval of that line, and a row goes where
its middle lies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from rankloom.llm.common import buckets_for, compact, joined, written

#: Bytes that a row counts besides its text.
ROW_OVERHEAD = 16
#: Rows of one window that adds up sizes or numbers rows.
ROWS_PER_BLOCK = 1024
#: Rows with their texts that a task hands on.
TEXTS_PER_TASK = 1 << 14


def min_cost_flow(supply: list[int], capacity: list[int]) -> dict[tuple[int, int], int]:
    """The cheapest transfers (old shard, new shard) -> bytes when staying in the shard of the same number is free and
    a moved byte costs 1. The capacities must add up to the supply.

    Successive shortest paths, all those of one length at once. The free ones, from a shard to itself, have no arc in common,
    so each takes what it can. Every other path leads through the hub and costs 1; no cheaper one opens up on the way, as what
    a shard keeps is full on one side. So the work is one pass over the shards.
    """
    if sum(supply) != sum(capacity):
        raise ValueError("the capacities must add up to the bytes there are")
    flow: dict[tuple[int, int], int] = {}
    for i, (n, room) in enumerate(zip(supply, capacity)):
        if min(n, room):
            flow[i, i] = min(n, room)
    kept = [flow.get((i, i), 0) for i in range(max(len(supply), len(capacity)))]
    leaves = [[i, n - kept[i]] for i, n in enumerate(supply) if n > kept[i]]
    takes = [[j, n - kept[j]] for j, n in enumerate(capacity) if n > kept[j]]
    while leaves:  # what reaches the hub leaves it in order: the fewest transfers of those amounts but one a shard
        amount = min(leaves[-1][1], takes[-1][1])
        flow[leaves[-1][0], takes[-1][0]] = flow.get((leaves[-1][0], takes[-1][0]), 0) + amount
        for end in (leaves, takes):
            end[-1][1] -= amount
            if not end[-1][1]:
                end.pop()
    return flow


def equal_capacities(total: int, shards: int) -> list[int]:
    return [total // shards + (i < total % shards) for i in range(shards)]


def _running(df: DataFrame, group: str, block: str, size: Column, out: str) -> DataFrame:
    """For each (group, block): what the blocks before it in its group add up to."""
    before = Window.partitionBy(group).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    return df.groupBy(group, block).agg(F.sum(size).alias("_sum")).select(
        group, block, F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias(out))


def reshard(rows: DataFrame, old: Column, shards: int) -> DataFrame:
    """Move ``rows`` (``doc_id``, ``text``) from their old shards to ``shards`` new ones of nearly equal bytes.

    ``old`` tells each row's old shard by any value; old shards are numbered in the order of these values (null first),
    and number k has its home in new shard k. Returns ``doc_id, text, size, text_crc32, old_shard, shard, slot, moved``: the texts
    go with their rows, and ``text_crc32`` is the one that was read in the old shard.
    Places are found on rows without their text, by a number that each row gets when it is read; the texts are dealt once, then.
    A null text has no bytes, null and repeated ids and repeated rows are rows like others, other columns aren't read,
    and an empty table gives an empty result. Number of old shards: as many as there are files, which the driver lists
    anyway; all else that the driver sees is one number a shard.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    whole = written(rows.select(
        F.monotonically_increasing_id().alias("_row"),
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        (F.octet_length(text).cast("bigint") + ROW_OVERHEAD).alias("size"),
        F.crc32(text).alias("text_crc32"),
        old.cast("string").alias("_old"),
    ), "reshard")
    lean = whole.drop("text")
    sizes = lean.groupBy("_old").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n")).collect()
    sizes.sort(key=lambda r: (r["_old"] is not None, r["_old"] or ""))
    count = sum(r["n"] for r in sizes)
    total = sum(r["bytes"] for r in sizes)
    flow = min_cost_flow([r["bytes"] for r in sizes], equal_capacities(total, shards))

    spark = rows.sparkSession
    cuts: list[list[tuple[int, int]]] = [[] for _ in sizes]  # of each old shard: (end of the interval, new shard)
    for i, j in sorted(flow, key=lambda arc: (arc[0], arc[1] != arc[0], arc[1])):
        cuts[i].append(((cuts[i][-1][0] if cuts[i] else 0) + flow[i, j], j))
    plan = spark.createDataFrame(
        [(r["_old"] is None, r["_old"] or "", i, ends) for i, (r, ends) in enumerate(zip(sizes, cuts))],
        "_none boolean, _name string, old_shard int, _cuts array<struct<end: bigint, shard: int>>")
    blocks = buckets_for(count, ROWS_PER_BLOCK)
    numbered = joined(
        lean.withColumns({"_none": F.col("_old").isNull(), "_name": F.coalesce("_old", F.lit(""))}), plan,
        ["_none", "_name"], "inner", sum(len(c) + 4 for c in cuts), 64)
    dealt = numbered.select(
        "_row", "doc_id", "size", "text_crc32", "old_shard", "_cuts",
        F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(blocks)).alias("_block"))

    starts = _running(dealt, "old_shard", "_block", F.col("size"), "_start")
    inside = Window.partitionBy("old_shard", "_block").orderBy("doc_id", "text_crc32", "size")
    upto = F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    middle = F.col("_start") + F.col("_upto") - (F.col("size") / 2).cast("bigint")
    sent = (
        dealt.withColumn("_upto", upto).join(starts, ["old_shard", "_block"])
        .withColumn("_at", middle)
        .select("_row", "doc_id", "size", "text_crc32", "old_shard", "_block",
                F.expr("filter(_cuts, c -> c.end > _at)[0].shard").alias("shard"))
    )
    sent = written(compact(sent, count), "sent")
    firsts = _running(sent, "shard", "_block", F.lit(1), "_first")
    place = Window.partitionBy("shard", "_block").orderBy("doc_id", "text_crc32", "size", "old_shard")
    numbered = sent.withColumn("_i", F.row_number().over(place) - 1).join(firsts, ["shard", "_block"])
    places = numbered.select(
        "_row", "size", "text_crc32", "old_shard", "shard", (F.col("_first") + F.col("_i")).alias("slot"))
    moved = whole.select("_row", "doc_id", "text").join(places, "_row")
    return compact(moved, count, TEXTS_PER_TASK).select(
        "doc_id", "text", "size", "text_crc32", "old_shard", "shard", "slot", (F.col("old_shard") != F.col("shard")).alias("moved"))


def rewrite_affected(docs: DataFrame, moves: DataFrame, path: str, file_bytes: int = 256 << 20) -> DataFrame:
    """Write every new shard that gains or loses rows, one folder a shard in files of about ``file_bytes``, and return
    the numbers of these shards. Rows are found again by ``doc_id``, so ids that repeat are an error: they would be written
    several times over. So are columns named ``_shard`` or ``_part``."""
    if {"_shard", "_part"} & set(docs.columns):
        raise ValueError("docs has a column _shard or _part")
    for side in (docs, moves):
        if not side.groupBy("doc_id").count().where("count > 1").isEmpty():
            raise ValueError("rows are found again by doc_id, which repeats")
    changed = moves.where("moved").select(F.explode(F.array("old_shard", "shard")).alias("shard")).distinct()
    parts = moves.groupBy("shard").agg(F.ceil(F.sum("size") / file_bytes).alias("_parts"))
    targets = moves.join(changed, "shard", "left_semi").join(parts, "shard").select(
        F.col("doc_id"), F.col("shard").alias("_shard"), F.pmod(F.col("slot"), F.col("_parts")).alias("_part"))
    docs.join(targets, "doc_id").repartition("_shard", "_part").drop("_part").write.partitionBy("_shard").parquet(path)
    return changed
