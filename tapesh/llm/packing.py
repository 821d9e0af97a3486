"""Items packed into containers of fixed capacity, by hierarchical residual packing.

Each partition packs its items best-fit, largest first, and emits the
containers that are nearly full. The underfull ones go on as items to a
round with fewer partitions, are packed best-fit again, whole, and so on up
the tree, until a round has one partition or nothing fits anywhere. Between
rounds containers that have no room for the smallest that is left are
emitted too. An item above the capacity is divided into full parts and a
rest; no other is.

Any two underfull containers of a partition exceed the capacity together, so
at most one of a partition is no more than half full, and a round frees at
most one container a partition. Where so many are left that one task can't
hold them, they are dealt anew each round, and the tree ends with the first
round that frees none. Items are dealt to partitions by a hash and sorted
within, so a lost task packs the same way again.

Defined cases: an item of size 0 takes no room and lies in the first
container by name ('empty' if there is no other); a null size has a null
container and a negative one counts as null; repeated items are items of
their own; an empty table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapesh.runtime import Scratch

CAPACITY = 2048
#: Room left in a container that counts as nearly full.
SLACK = 8
#: Items packed by one task.
ITEMS = 10_000
#: Partitions of a round that one of the next takes in.
FAN_IN = 8


def best_fit(sizes: list[int], capacity: int) -> list[int]:
    """The container of each size, in the order given: the fullest one with room, else a new one."""
    room: list[tuple[int, int]] = []  # of each container: room left, number
    where = []
    opened = 0
    for size in sizes:
        at = bisect_left(room, (size, -1))
        if at < len(room):
            left, k = room.pop(at)
        else:
            left, k = capacity, opened
            opened += 1
        where.append(k)
        insort(room, (left - size, k))
    return where


def pack(items: DataFrame, key: str, size: str, capacity: int = CAPACITY, slack: int = SLACK, items_per_task: int = ITEMS) -> DataFrame:
    """<key>, part_no, container_id, part_size: every item, or each part of one above the capacity."""
    scratch = Scratch(items.sparkSession, "packing")
    rows = scratch.write(items.select(F.col(key).alias("id"), F.when(F.col(size) >= 0, F.col(size)).cast("long").alias("s")), "items")
    full = F.expr(f"s div {capacity}")
    rest = F.expr(f"s % {capacity}")
    parts = F.concat(F.array_repeat(F.lit(capacity).cast("long"), full.cast("int")), F.when(rest > 0, F.array(rest)).otherwise(F.array().cast("array<bigint>")))
    cut = rows.where("s > 0").select("id", F.posexplode(parts).alias("part_no", "size"))

    # a full part is a container of its own; its id is made of the item's
    whole = cut.where(F.col("size") == capacity).select("id", "part_no", F.concat_ws("-", F.lit("w"), "id", "part_no").alias("container_id"), "size")
    loose = cut.where(F.col("size") < capacity)
    kind = items.schema[key].dataType.simpleString()
    held = f"array<struct<id:{kind},part_no:int,size:bigint>>"

    n = max(1, -(-rows.count() // items_per_task))
    schema = f"container_id string, filled bigint, held {held}"
    bins = scratch.write(loose.repartition(n, "id", "part_no").mapInPandas(_first_round(capacity), schema), "round0")
    done: list[DataFrame] = []

    def parted(bins: DataFrame) -> tuple[DataFrame, int]:
        """Containers that are left for the next round and their number; the others are done."""
        smallest = bins.where(F.col("filled") < capacity - slack).agg(F.min("filled")).first()[0]
        open_ = (F.col("filled") < capacity - slack) & (F.col("filled") + F.lit(smallest) <= capacity)
        done.append(bins.where(~open_) if smallest is not None else bins)
        left = bins.where(open_ if smallest is not None else F.lit(False))
        return left, left.count() if smallest is not None else 0

    left, before = parted(bins)
    level = 0
    while n > 1 and before > 1:
        level += 1
        n = max(1, -(-n // FAN_IN), -(-before // items_per_task))
        dealt = left.repartition(n, "container_id", F.lit(level))
        bins = scratch.write(dealt.mapInPandas(_next_round(capacity, level), schema), f"round{level}")
        packed_before = before
        left, before = parted(bins)
        if n > 1 and bins.count() == packed_before:
            break
    packed = left
    for d in done:
        packed = packed.unionByName(d)
    out = packed.select("container_id", F.explode("held").alias("h")).select(F.col("h.id").alias("id"), F.col("h.part_no").alias("part_no"), "container_id", F.col("h.size").alias("size"))
    out = out.unionByName(whole)
    first = packed.select("container_id").unionByName(whole.select("container_id")).agg(F.coalesce(F.min("container_id"), F.lit("empty")).alias("container_id"))
    rest_of = rows.where(F.col("s").isNull() | (F.col("s") == 0)).crossJoin(F.broadcast(first))  # one row
    rest_of = rest_of.select("id", F.lit(0).alias("part_no"), F.when(F.col("s") == 0, F.col("container_id")).alias("container_id"), F.col("s").alias("size"))
    out = out.unionByName(rest_of)
    return out.select(F.col("id").alias(key), "part_no", "container_id", F.col("size").alias("part_size"))


def _first_round(capacity: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        items = [row for pdf in batches for row in zip(pdf["id"].tolist(), pdf["part_no"].tolist(), pdf["size"].tolist(), strict=True)]
        items.sort(key=lambda x: (-x[2], x[0], x[1]))
        yield from _bins(best_fit([x[2] for x in items], capacity), [[x] for x in items], [x[2] for x in items], 0)

    return run


def _next_round(capacity: int, level: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = [row for pdf in batches for row in zip(pdf["filled"].tolist(), pdf["container_id"].tolist(), pdf["held"].tolist(), strict=True)]
        rows.sort(key=lambda x: (-x[0], x[1]))
        held = [[(h["id"], h["part_no"], h["size"]) for h in x[2]] for x in rows]
        yield from _bins(best_fit([x[0] for x in rows], capacity), held, [x[0] for x in rows], level)

    return run


def _bins(where: list[int], held: list[list[tuple]], sizes: list[int], level: int, batch: int = 5000) -> Iterator[pd.DataFrame]:
    p = TaskContext.get().partitionId()
    n = max(where, default=-1) + 1
    inside: list[list[tuple]] = [[] for _ in range(n)]
    filled = [0] * n
    for k, items, s in zip(where, held, sizes, strict=True):
        inside[k] += items
        filled[k] += s
    for at in range(0, n, batch):
        chunk = range(at, min(n, at + batch))
        yield pd.DataFrame(
            {
                "container_id": [f"{level}-{p}-{k}" for k in chunk],
                "filled": [filled[k] for k in chunk],
                "held": [[{"id": a, "part_no": b, "size": c} for a, b, c in inside[k]] for k in chunk],
            }
        )
