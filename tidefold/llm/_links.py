"""Exact links between 64-bit fingerprints by shared blocks, and connected components, all distributed."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import checkpoint

#: Bits of the five blocks. A pair that differs in at most three bits agrees on two blocks at least,
#: so every such pair meets under one of the ten keys of two blocks (25 or 26 bits each).
BLOCKS = (13, 13, 13, 13, 12)
MAX_BITS = 3
#: A key with more fingerprints is dealt in chunks of this size, each pair of chunks being a task's
#: unit of work: no group grows with the data.
CHUNK = 1024


#: A key that holds more than this part of all rows is hot; so fewer than HOT_KEYS keys are.
HOT_KEYS = 1000


def join_by_key(rows: DataFrame, table: DataFrame, key: str, n: str = "n") -> DataFrame:
    """Rows joined with a table of one row for each of their keys, no key's rows being dealt to one task.

    ``n`` of the table is the number of rows that have the key. The hot keys, fewer than HOT_KEYS
    whatever the input, are joined by broadcast, the others by shuffle. Give it checkpointed input, which is read twice.
    """
    total, most = table.agg(F.sum(n), F.max(n)).first()
    least = (total or 0) // HOT_KEYS
    if (most or 0) <= least or total < HOT_KEYS:
        return rows.join(table.drop(n), key)
    hot = F.broadcast(table.where(F.col(n) > least).drop(n))
    cold = rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(table.where(F.col(n) <= least).drop(n), key)
    return rows.join(hot, key).unionByName(cold)


def _keys(fp: str) -> list:
    starts = [sum(BLOCKS[:i]) for i in range(len(BLOCKS))]
    out = []
    for n, (a, b) in enumerate(combinations(range(len(BLOCKS)), 2)):
        part = [F.shiftrightunsigned(F.col(fp), starts[i]).bitwiseAND(F.lit((1 << BLOCKS[i]) - 1)) for i in (a, b)]
        out.append(F.lit(n << 32) + F.shiftleft(part[0], BLOCKS[b]) + part[1])
    return out


def spanning_edges(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (smallest of its component, member) of the graph that links values of at most MAX_BITS difference."""
    n = len(values)
    if n == 2:
        close = int(values[0] ^ values[1]).bit_count() <= MAX_BITS
        return (values[:1], values[1:]) if close else (values[:0], values[:0])
    values = np.sort(values)
    near = np.bitwise_count(values[:, None] ^ values[None, :]) <= MAX_BITS
    label = np.arange(n)
    open_rows = np.flatnonzero(near.sum(1) > 1)
    while True:
        new = label.copy()
        for i in open_rows:
            new[i] = label[near[i]].min()
        new = new[new]
        if (new == label).all():
            break
        label = new
    member = np.flatnonzero(label != np.arange(n))
    return values[label[member]], values[member]


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        groups = batch.column(0)
        flat = groups.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
        ends = np.cumsum(groups.value_lengths().to_numpy(zero_copy_only=False))
        left, right, start = [flat[:0]], [flat[:0]], 0
        for end in ends:
            if end - start > 1:
                a, b = spanning_edges(flat[start:end])
                left.append(a)
                right.append(b)
            start = end
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).view(np.int64)) for x in (left, right)], names=["a", "b"])


def meetings(keyed: DataFrame, item: str, size: int) -> DataFrame:
    """Groups (``members``) of items under a ``key``, 2 x ``size`` items at most, in which every pair under a key meets.

    A key with more than ``size`` items is dealt in chunks, and each pair of chunks is a group: no
    group grows with the data, and none is gathered in one task.
    """
    sizes = checkpoint(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").withColumn("g", F.ceil(F.col("n") / size).cast("int")))
    chunk = F.pmod(F.xxhash64(item, F.lit(7)), F.col("g")).cast("int")
    met = join_by_key(keyed, sizes, "key").withColumn("c", chunk).select(item, "key", "c", F.explode(F.sequence(F.lit(0), F.col("g") - 1)).alias("j"))
    groups = met.groupBy("key", F.least("c", "j").alias("lo"), F.greatest("c", "j").alias("hi")).agg(
        F.collect_list(item).alias("members")
    )
    return groups.where(F.size("members") > 1).select("members")


def near_links(fps: DataFrame, fp: str = "fp") -> DataFrame:
    """Edges (a, b) whose components are those of all pairs of distinct fingerprints within MAX_BITS.

    ``fps`` holds distinct non-null longs. Each group of fingerprints under a key gives a spanning
    forest of its close pairs, never the pairs themselves.
    """
    keyed = fps.select(fp, F.explode(F.array(*_keys(fp))).alias("key"))
    return meetings(keyed, fp, CHUNK).mapInArrow(_verify, "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node that has an edge, root the smallest (signed) node of its component.

    Alternating large-star and small-star steps: each is a minimum by node, aggregated before the
    shuffle, and a join back that broadcasts the minima of hubs, so a hub is never gathered in one task.
    Lineage is cut after each step; the number of rounds grows with the logarithm of a component's size.
    """
    edges = checkpoint(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b"))
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = checkpoint(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"), F.count(F.lit(1)).alias("n")))
        large = join_by_key(both, low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        large = checkpoint(large.distinct())
        low = checkpoint(large.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("n")))
        small = join_by_key(large, low, "a")
        small = small.select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        edges = checkpoint(small.select("e.a", "e.b").where("a <> b").distinct())
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
            return roots.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        state = now
