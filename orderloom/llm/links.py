"""Connected components of links between rows, and exchange of packed sorted runs."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm._shared import stored


#: Links that one task contracts.
TASK_LINKS = 500_000


def contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links of one task as stars: each id with the smallest one that this task's links reach."""
    links = [np.stack([b.column(0).to_numpy(), b.column(1).to_numpy()], 1) for b in batches if b.num_rows]
    if not links:
        return
    ids, ends = np.unique(np.concatenate(links), return_inverse=True)
    parent = list(range(len(ids)))
    for a, b in ends.reshape(-1, 2).tolist():
        while parent[a] != a:
            parent[a] = a = parent[parent[a]]
        while parent[b] != b:
            parent[b] = b = parent[parent[b]]
        if a != b:  # ids are sorted: the smaller place is the smaller id
            parent[max(a, b)] = min(a, b)
    for k in range(len(parent)):
        parent[k] = parent[parent[k]]
    root = ids[np.array(parent)]
    moved = root != ids
    yield pa.RecordBatch.from_arrays([pa.array(ids[moved]), pa.array(root[moved])], ["a", "b"])


def components(edges: DataFrame, rounds: int = 40, task_links: int = TASK_LINKS) -> DataFrame:
    """id, component (smallest id reachable) of every id that occurs in edges (a, b).

    Tasks of bounded size first contract the links they hold to stars; what one task holds whole is
    finished by that. Then large-star and small-star steps alternate: links are moved towards the smallest
    neighbour until each id hangs on its component's smallest one. No step gathers the neighbours of an
    id; each takes their minimum, so an id with any number of links is summed up before it is shuffled.
    """
    pairs = stored(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    )
    tasks = max(1, -(-pairs.count() // task_links))
    pairs = stored(pairs.repartition(tasks).mapInArrow(contracted, "a long, b long"))
    for _ in range(rounds if tasks > 1 else 0):
        both = pairs.union(pairs.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.filter("a <> b").union(least.filter("a <> m")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(low, "a")
        small = moved.select(F.greatest("b", "m").alias("a"), F.least("b", "m").alias("b")).filter("a <> b")
        after = stored(small.union(low).distinct())
        # Stars only: no id is both a centre and hung on another.
        done = after.select(F.col("b").alias("a")).join(after.select("a"), "a", "left_semi").isEmpty() and (
            after.groupBy("a").count().filter("count > 1").isEmpty()
        )
        pairs = after
        if done:
            break
    else:
        if tasks > 1:
            raise RuntimeError(f"components not found in {rounds} rounds")
    return pairs.select(F.col("a").alias("id"), F.col("b").alias("component")).union(
        pairs.select("b", "b").distinct().toDF("id", "component")
    )
