"""Filling fixed-capacity containers: optimal length buckets, token-budget batches inside each bucket, then topping up.

* The global histogram of sizes (at most one row per size up to the capacity) goes to the driver, where dynamic
  programming chooses the bucket bounds that minimise padding, that is the number of containers when every item is
  counted with the upper bound of its bucket.
* Items are spread by the hash of their key over shards of about ``SHARD_CONTAINERS`` containers. In a shard the buckets
  come from the longest to the shortest. Batches form inside a bucket up to the token budget: a long item, then further
  items of the same bucket while they fit, the longest and then the shortest first (``stage`` 1).
* The room that the batches of a bucket leave is topped up with items of shorter buckets, tightest room first, before these
  form batches of their own (``stage`` 2).

So the bounds decide the containers: other bounds give other batches. ``padding`` of the bounds is what the programme
minimises (:func:`padded_containers`).

Semantics: an item larger than the capacity is divided into full parts and a rest; no other item is divided. Items of
size 0 take no room but are kept. Null sizes are left out. Ties are broken by key, so the result is the same on every
run with the same number of shards. Repeated keys are separate items.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections import defaultdict

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

SHARD_CONTAINERS, BUCKETS = 4_000, 16


def bucket_bounds(histogram: dict[int, int], capacity: int, buckets: int = BUCKETS) -> list[int]:
    """Upper bounds of at most ``buckets`` length buckets over sizes 1..``capacity`` with the fewest padded containers."""
    counts = np.zeros(capacity + 1)
    for size, n in histogram.items():
        if 0 < size <= capacity:
            counts[size] += n
    sizes = np.flatnonzero(counts)
    if not len(sizes):
        return [capacity]
    below = np.concatenate([[0.0], np.cumsum(counts[sizes])])
    per = np.array([capacity // s for s in sizes], dtype=float)
    best = np.concatenate([[0.0], np.full(len(sizes), np.inf)])
    choices = []
    for _ in range(min(buckets, len(sizes))):
        # cost[i, j]: sizes i..j in one bucket
        new, choice = best.copy(), np.full(len(sizes) + 1, -1)
        for j in range(len(sizes)):
            cost = best[: j + 1] + (below[j + 1] - below[: j + 1]) / per[j]
            i = int(cost.argmin())
            if cost[i] < new[j + 1] - 1e-9:
                new[j + 1], choice[j + 1] = cost[i], i
        choices.append(choice)
        best = new
    bounds, j = [], len(sizes)
    for choice in reversed(choices):
        if j and choice[j] >= 0:
            bounds.append(int(sizes[j - 1]))
            j = int(choice[j])
    return sorted(bounds)


def divided(items: DataFrame, capacity: int) -> DataFrame:
    """``key, part, start, size``: every item as its parts of at most ``capacity``."""
    n = F.greatest(F.ceil(F.col("size") / capacity), F.lit(1)).cast("int")
    parts = items.filter("size is not null").select("key", "size", F.explode(F.sequence(F.lit(0), n - 1)).alias("part"))
    start = F.col("part").cast("long") * capacity
    return parts.select("key", "part", start.alias("start"), F.least(F.lit(capacity), F.col("size") - start).cast("int").alias("size"))


def padded_containers(histogram: dict[int, int], capacity: int, bounds: list[int]) -> float:
    """Containers needed when every item is counted with the upper bound of its bucket."""
    return sum(n / (capacity // bounds[bisect_left(bounds, size)]) for size, n in histogram.items() if size > 0)


def filled(sizes: list[int], buckets: list[int], capacity: int, bounds: list[int]) -> tuple[list[int], list[int]]:
    """Container and stage of each item; the items come by bucket and size, the largest first.

    From the longest bucket to the shortest: first the items top up what longer buckets left open, tightest room first;
    the others form batches of their own bucket, each filled in order up to the token budget.
    """
    rooms: list[int] = []  # sorted rooms that earlier buckets left
    by_room: dict[int, list[int]] = defaultdict(list)
    boxes, stages, made, i = [0] * len(sizes), [0] * len(sizes), 0, 0

    def leave(box: int, room: int) -> None:
        if room > 0:
            rooms.insert(bisect_left(rooms, room), room)
            by_room[room].append(box)

    while i < len(sizes):
        end = i
        while end < len(sizes) and buckets[end] == buckets[i]:
            end += 1
        rest = []
        for x in range(i, end):  # stage 2: room of longer buckets
            at = bisect_left(rooms, sizes[x])
            if at < len(rooms):
                room = rooms.pop(at)
                boxes[x], stages[x] = by_room[room].pop(), 2
                leave(boxes[x], room - sizes[x])
            else:
                rest.append(x)
        # stage 1: batches of this bucket, a long item with as many short ones of the same bucket as its room takes
        low, high = 0, len(rest) - 1
        while low <= high:
            room = capacity
            while low <= high and sizes[rest[low]] <= room:
                boxes[rest[low]], stages[rest[low]] = made, 1
                room -= sizes[rest[low]]
                low += 1
            while low <= high and sizes[rest[high]] <= room:
                boxes[rest[high]], stages[rest[high]] = made, 1
                room -= sizes[rest[high]]
                high -= 1
            leave(made, room)
            made += 1
        i = end
    return boxes, stages


def pack(items: DataFrame, capacity: int, buckets: int = BUCKETS) -> DataFrame:
    """``container_id, bucket, stage, key, part, start, size`` for ``items`` (``key bigint, size``)."""
    parts = divided(items, capacity)
    histogram = {r["size"]: r["n"] for r in parts.groupBy("size").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most capacity + 1 rows
    bounds = bucket_bounds(histogram, capacity, buckets)
    tokens = sum(s * n for s, n in histogram.items())
    shards = max(1, math.ceil(tokens / (capacity * SHARD_CONTAINERS)), math.ceil(sum(histogram.values()) / (50 * SHARD_CONTAINERS)))
    shard = F.pmod(F.xxhash64("key", "part"), F.lit(shards)).cast("int")

    def fill(p: pd.DataFrame) -> pd.DataFrame:
        base = int(p["shard"].iloc[0]) * (1 << 32)
        p = p.assign(bucket=[bisect_left(bounds, s) for s in p["size"]]).sort_values(["bucket", "size", "key", "part"], ascending=[False, False, True, True], kind="stable")
        box, stage = filled(p["size"].tolist(), p["bucket"].tolist(), capacity, bounds)
        return p.assign(container_id=[base + b for b in box], stage=stage)[["container_id", "bucket", "stage", "key", "part", "start", "size"]]

    return parts.withColumn("shard", shard).groupBy("shard").applyInPandas(fill, "container_id bigint, bucket int, stage int, key bigint, part int, start bigint, size int")
