"""Containers of fixed capacity, filled with items of varying length.

The histogram of lengths, which has at most as many entries as the capacity, decides everything: dynamic
programming cuts it into length buckets with the least padding for their number, and batches under the token
budget are formed of whole buckets at once, longest first; room that a batch leaves goes to the best fitting
bucket below. The plan is a table of ranges, bounded by the capacity. Each item then finds its container by its
rank in its bucket. The items themselves never leave the cluster.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tomeflow.functions.durable import stored
from tomeflow.operators.ordering import running_total

CAPACITY = 2048
#: Padding allowed, as a share of all tokens.
PADDING = 0.001


def _cut(counts: np.ndarray, cost: float) -> tuple[list[int], float]:
    """Upper ends of the buckets that minimise the padding plus ``cost`` a bucket, and that padding.

    ``counts[n]`` is the number of items of length n. Only lengths that occur are ends. A bucket that begins behind the
    i-th length costs a linear function of its upper end, so the best beginning for each end is on the lower hull of
    these lines, which is walked once: the work is linear in the number of lengths.
    """
    lengths = np.flatnonzero(counts)
    n = counts[lengths].astype(np.float64)
    items, tokens = np.concatenate([[0], np.cumsum(n)]).tolist(), np.concatenate([[0], np.cumsum(n * lengths)]).tolist()
    best, came = [0.0], [0]
    hull: list[int] = []  # beginnings, those for shorter ends first
    at = 0

    def meet(a: int, b: int) -> float:
        """The end from which on beginning ``b`` is better than ``a``."""
        return (best[b] + tokens[b] - best[a] - tokens[a]) / (items[b] - items[a])

    for r, length in enumerate(lengths.tolist(), 1):
        i = r - 1
        while len(hull) >= 2 and meet(hull[-1], i) <= meet(hull[-2], hull[-1]):
            hull.pop()
        hull.append(i)
        at = min(at, len(hull) - 1)
        while at + 1 < len(hull) and meet(hull[at], hull[at + 1]) <= length:
            at += 1
        b = hull[at]
        best.append(best[b] + (items[r] - items[b]) * length - (tokens[r] - tokens[b]) + cost)
        came.append(b)
    ends, r = [], len(lengths)
    while r:
        ends.append(int(lengths[r - 1]))
        r = came[r]
    return ends[::-1], best[-1] - cost * len(ends)


def buckets(histogram: dict[int, int], capacity: int, padding: float = PADDING) -> list[int]:
    """The fewest buckets, by their upper ends, whose padding is at most a share of the tokens."""
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in histogram.items():
        counts[length] = n
    if not counts.any():
        return []
    allowed = padding * float((counts * np.arange(capacity + 1)).sum())
    low, high = 0.0, 1.0
    while _cut(counts, high)[1] <= allowed and high < 1e18:
        low, high = high, high * 8
    for _ in range(24):
        middle = (low + high) / 2
        low, high = (middle, high) if _cut(counts, middle)[1] <= allowed else (low, middle)
    return _cut(counts, low)[0]


def plan(ends: list[int], counts: list[int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Rows (bucket, first rank, past rank, first container, items a container): best fit over whole buckets, longest first."""
    rows: list[tuple[int, int, int, int, int]] = []
    room: dict[int, list[tuple[int, int]]] = {}  # room left: ranges of containers
    made = 0
    for b in range(len(ends) - 1, -1, -1):
        length, rank, left = ends[b], 0, counts[b]
        for free in sorted(k for k in room if k >= length):
            if not left:
                break
            each, ranges = free // length, room.pop(free)
            while ranges and left:
                first, past = ranges.pop()
                take = min(past - first, left // each)
                if take:
                    rows.append((b, rank, rank + take * each, first, each))
                    rank, left = rank + take * each, left - take * each
                    room.setdefault(free - each * length, []).append((first, first + take))
                    first += take
                if first < past and 0 < left < each:
                    rows.append((b, rank, rank + left, first, left))
                    room.setdefault(free - left * length, []).append((first, first + 1))
                    rank, left, first = rank + left, 0, first + 1
                if first < past:
                    ranges.append((first, past))
            if ranges:
                room.setdefault(free, []).extend(ranges)
        each = capacity // length
        for k, n in ((left // each, each), (1 if left % each else 0, left % each)):
            if k:
                rows.append((b, rank, rank + k * n, made, n))
                room.setdefault(capacity - n * length, []).append((made, made + k))
                rank, made = rank + k * n, made + k
    return rows


def pack(sizes: DataFrame, capacity: int = CAPACITY, key: str = "doc_id", size: str = "n_tokens") -> DataFrame:
    """(container_id, ``key``, piece_no, start, n_tokens) of every item, or of every piece of an item above the capacity.

    Items above the capacity are cut into pieces of just the capacity and a rest; no other item is cut. Items without
    size, or of size null, take no room and have no row. ``key`` must identify a row. No container holds more than
    ``capacity``, and ids are without gaps from 0.
    """
    if capacity < 1:
        raise ValueError("the capacity must be positive")
    spark = sizes.sparkSession
    whole = sizes.select(F.col(key), F.col(size).cast("long").alias("_n")).where("_n > 0")
    last = F.floor((F.col("_n") - 1) / capacity)
    items = whole.select(key, "_n", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("piece_no"))
    items = items.select(key, F.col("piece_no").cast("int"), (F.col("piece_no") * capacity).alias("start"), F.least(F.lit(capacity).cast("long"), F.col("_n") - F.col("piece_no") * capacity).cast("int").alias("n_tokens"))
    items = stored(items, "items")
    histogram = {r.n_tokens: r.n for r in items.groupBy("n_tokens").agg(F.count("*").alias("n")).toLocalIterator()}
    ends = buckets(histogram, capacity)
    counts = [sum(n for length, n in histogram.items() if (ends[b - 1] if b else 0) < length <= end) for b, end in enumerate(ends)]
    ranges = plan(ends, counts, capacity)
    of_length = spark.createDataFrame([(length, next(b for b, end in enumerate(ends) if length <= end)) for length in sorted(histogram)], "n_tokens int, bucket int")
    table = spark.createDataFrame(ranges, "bucket int, first long, past long, container long, each long")
    placed = items.join(F.broadcast(of_length), "n_tokens").withColumn("one", F.lit(1).cast("long"))
    ranked = running_total(placed, ["bucket"], [key, "piece_no"], "one", "rank").withColumn("rank", F.col("rank") - 1)
    found = ranked.join(F.broadcast(table), (ranked.bucket == table.bucket) & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("past")))
    return found.select((F.col("container") + F.floor((F.col("rank") - F.col("first")) / F.col("each"))).alias("container_id"), key, "piece_no", "start", "n_tokens")


def fill(packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Number of containers, tokens in them, the fullest one, and the share of their room that is used."""
    each = packed.groupBy("container_id").agg(F.sum("n_tokens").alias("used"))
    return each.agg(F.count("*").alias("n_containers"), F.coalesce(F.sum("used"), F.lit(0)).alias("n_tokens"), F.max("used").alias("fullest"), F.round(F.sum("used") / (F.count("*") * capacity), 6).alias("used_share"))
