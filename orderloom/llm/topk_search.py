"""Exact top-k search by inner product, block at a time.

Components are whole numbers floor(256 * x), so scores are exact. Every dimension is a term, once for its positive and
once for its negative weights. Rows are put in an order in which near vectors stand together (a tree of
median splits, fitted on a bounded sample; it decides the order alone, every row is indexed) and cut into blocks of
consecutive rows. A block is a forward index (ids and vectors) and the maxima of its terms. The sum of a query's
weights times the maxima bounds the score of every row of the block.

Queries are cut into chunks in the same way; chunks meet packs of block maxima. Each query's blocks are
ordered by bound. In rounds, the first few blocks of each query, then more, then all that are left are scored through
their forward indexes; after each round the kth score of a query is known better, and blocks whose bound is below it are
never read for that query. A block whose bound equals the kth score is scored, as ties go to the smaller id. Rows of a
task are a chunk with a pack, or a chunk with a block, of bounded size each; nothing is grouped by query but its k
best rows of each block.

Vectors that are null or hold null or non-finite components, and rows without an id, take no part; vectors of different
lengths do not meet, and the product of empty ones is 0. Rows of the query's own id are no candidates. A repeated row is a
candidate as often as it stands there; a repeated query row is answered as often, under the same id. Components count as
at most 2**53 / 256 in size, scores as at most what a long holds. Empty input gives empty output, and so does a
table of one row. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderloom.llm._shared import stored
from orderloom.llm.vectors import matrices, numbered

SCALE, LARGEST = 256, 2**53
BLOCK, CHUNK, PACK = 256, 256, 2048
BUFFER = 64 * BLOCK
SAMPLE, LEAF = 4096, 16
#: Blocks of each query scored in each round; one more round takes all that are left.
ROUNDS = (4, 32)
LONG = np.iinfo(np.int64)


# --- numbers -----------------------------------------------------------------------------------


def whole(matrix: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.clip(np.floor(SCALE * matrix), -LARGEST, LARGEST).astype(np.int64)


def packed(x: np.ndarray) -> bytes:
    """A matrix of whole numbers in two, four or eight bytes each, as its largest needs."""
    most = int(np.abs(x).max(initial=0))
    return x.astype(np.int16 if most < 2**15 else np.int32 if most < 2**31 else np.int64).tobytes()


def unpacked(data: bytes, rows: int, length: int) -> np.ndarray:
    width = len(data) // max(1, rows * length)
    return np.frombuffer(data, {0: np.int64, 2: np.int16, 4: np.int32, 8: np.int64}[width]).astype(np.int64).reshape(rows, length)


def scores(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products, exact; beyond a long they count as its ends."""
    most = int(np.abs(queries).max(initial=0)) * int(np.abs(rows).max(initial=0)) * queries.shape[1]
    if most < 2**53:
        return (queries.astype(float) @ rows.astype(float).T).astype(np.int64)
    if most < 2**63:
        return queries @ rows.T
    exact = queries.astype(object) @ rows.astype(object).T
    return np.clip(exact, LONG.min, LONG.max).astype(np.int64)


def bounds(queries: np.ndarray, top: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Sums of weights times term maxima: no row of the block scores more. Rounded upwards where doubles are not exact."""
    q, t, s = queries.astype(float), top.astype(float), low.astype(float)
    out = np.maximum(q, 0) @ t.T + np.minimum(q, 0) @ s.T
    size = np.abs(q) @ np.maximum(np.abs(t), np.abs(s)).T
    return out + np.where(size < 2**53, 0, size * 1e-12)


# --- order of rows -----------------------------------------------------------------------------


def axis(x: np.ndarray) -> np.ndarray:
    """The direction between two rows far apart."""
    one = x[((x - x.mean(0)) ** 2).sum(1).argmax()]
    return x[((x - one) ** 2).sum(1).argmax()] - one


def tree(x: np.ndarray, leaf: int = LEAF) -> tuple | None:
    """Median splits: (direction, edge, below, above, leaves); None is a leaf."""
    if len(x) <= leaf:
        return None
    direction = axis(x)
    along = x @ direction
    edge = np.median(along)
    below = along < edge
    if not below.any():
        return None
    parts = tree(x[below], leaf), tree(x[~below], leaf)
    return direction, edge, *parts, sum(p[4] if p else 1 for p in parts)


def leaves(node: tuple | None, x: np.ndarray) -> np.ndarray:
    """The place of each row's leaf among all leaves."""
    if node is None or not len(x):
        return np.zeros(len(x), np.int64)
    direction, edge, left, right, _ = node
    below, out = x @ direction < edge, np.zeros(len(x), np.int64)
    out[below] = leaves(left, x[below])
    out[~below] = (left[4] if left else 1) + leaves(right, x[~below])
    return out


def runs(x: np.ndarray, size: int) -> list[np.ndarray]:
    """Rows as runs of ``size`` near ones (the last may be shorter), by splits between whole runs."""
    done, todo = [], [np.arange(len(x))]
    while todo:
        at = todo.pop()
        if len(at) <= size:
            done.append(at)
            continue
        along = x[at] @ axis(x[at])
        middle = (-(-len(at) // size) // 2) * size
        order = np.argsort(along, kind="stable")
        todo += [at[order[middle:]], at[order[:middle]]]
    return done


# --- index -------------------------------------------------------------------------------------


def trees(rows: DataFrame, sample: int) -> dict[int, tuple | None]:
    """A tree for each length of vector in a sample of the rows with the smallest hashes."""
    taken = rows.filter("id IS NOT NULL AND vector IS NOT NULL").orderBy(F.xxhash64("id", "vector")).limit(sample)
    batches = taken.toArrow().to_batches()
    found: dict[int, list[np.ndarray]] = {}
    for batch in batches:
        for _, matrix in matrices(batch):
            found.setdefault(matrix.shape[1], []).append(whole(matrix).astype(float))
    return {length: tree(np.concatenate(parts)) for length, parts in found.items()}


def cut(rows: DataFrame, by_length: dict[int, tuple | None], size: int) -> DataFrame:
    """Rows as blocks of ``size``: block, length, n, ids, vectors, and the maxima and minima of each term."""

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, matrix in matrices(batch):
                x, length = whole(matrix), matrix.shape[1]
                place = leaves(by_length.get(length), x.astype(float))
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(np.full(len(x), length, np.int32)), pa.array(place), pa.array([packed(v) for v in x], pa.binary())],
                    ["id", "length", "leaf", "vector"],
                )

    def blocks(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(held)
        ids, lengths, vectors = table.column("id").to_numpy(), table.column("length").to_numpy(), table.column("vector").to_pylist()
        for length in np.unique(lengths).tolist():
            own = np.flatnonzero(lengths == length)
            x = np.concatenate([unpacked(vectors[k], 1, length) for k in own.tolist()])
            out = []
            for at in runs(x.astype(float), size) if length else np.array_split(np.arange(len(x)), -(-len(x) // size)):
                part = x[at]
                out.append((length, len(at), ids[own[at]].tobytes(), packed(part), packed(part.max(0)[None]), packed(part.min(0)[None])))
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, row)) for row in out], schema)

    def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= BUFFER:
                yield from blocks(held)
                held = []
        if held:
            yield from blocks(held)

    schema = pa.schema(
        [("length", pa.int32()), ("n", pa.int32()), *((name, pa.binary()) for name in ("ids", "vectors", "top", "low"))]
    )
    spread = (
        rows.filter("id IS NOT NULL")
        .mapInArrow(placed, "id long, length int, leaf long, vector binary")
        .withColumn("spread", F.xxhash64("id", "vector"))
    )
    order = ["length", "leaf", "spread"]
    ordered = spread.repartitionByRange(*order).sortWithinPartitions(*order).select("id", "length", "vector")
    made = ordered.mapInArrow(gathered, "length int, n int, ids binary, vectors binary, top binary, low binary")
    return stored(made.withColumn("block", F.monotonically_increasing_id()))


def packs(blocks: DataFrame) -> DataFrame:
    """Maxima and minima of up to ``PACK`` blocks in a row: length, blocks, top, low."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            block, lengths = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            top, low = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            for length in np.unique(lengths).tolist():
                own = np.flatnonzero(lengths == length)
                for begin in range(0, len(own), PACK):
                    at = own[begin : begin + PACK]
                    both = [np.concatenate([unpacked(side[k], 1, length) for k in at.tolist()]) for side in (top, low)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([length], pa.int32()), pa.array([block[at].tobytes()], pa.binary()), *(pa.array([packed(x)], pa.binary()) for x in both)],
                        ["length", "blocks", "top", "low"],
                    )

    made = blocks.select("block", "length", "top", "low").mapInArrow(run, "length int, blocks binary, top binary, low binary")
    return stored(made.withColumn("pack", F.monotonically_increasing_id()))


# --- search ------------------------------------------------------------------------------------


def _bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """chunk, place, block, bound of the blocks that may hold a row as good as a query's kth."""
    for batch in batches:
        for r in batch.to_pylist():
            blocks = np.frombuffer(r["blocks"], np.int64)
            queries = unpacked(r["vectors"], r["n"], r["length"])
            top, low = (unpacked(r[side], len(blocks), r["length"]) for side in ("top", "low"))
            least = np.full(r["n"], -np.inf)
            for known in r["known"] or []:
                least[known["place"]] = known["score"]
            bound = bounds(queries, top, low)
            q, b = np.nonzero(bound >= least[:, None])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(q), r["chunk"])), pa.array(q.astype(np.int32)), pa.array(blocks[b]), pa.array(bound[q, b])],
                ["chunk", "place", "block", "bound"],
            )


def _scored(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                places = np.sort(np.array(r["places"], np.int64))
                own = np.frombuffer(r["ids"], np.int64)[places]
                ids = np.frombuffer(r["block_ids"], np.int64)
                found = scores(unpacked(r["vectors"], r["n"], r["length"])[places], unpacked(r["block_vectors"], len(ids), r["length"]))
                q, v = _best(found, ids, own, k)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(q), r["chunk"])), pa.array(places[q].astype(np.int32)), pa.array(own[q]), pa.array(ids[v]), pa.array(found[q, v])],
                    ["chunk", "place", "query_id", "vec_id", "score"],
                )

    return run


def _best(found: np.ndarray, ids: np.ndarray, own: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of each row's ``k`` largest scores, ties to the smaller id, its own id left out."""
    other = ids != own[:, None]
    if found.shape[1] > k:
        other &= found >= np.partition(np.where(other, found, LONG.min), -k, axis=1)[:, [-k]]
    q, v = np.nonzero(other)
    order = np.lexsort((ids[v], ~found[q, v], q))  # ~x falls as x rises, without overflow
    q, v = q[order], v[order]
    rank = np.arange(len(q)) - np.searchsorted(q, q)
    return q[rank < k], v[rank < k]


def search(vectors: DataFrame, queries: DataFrame, k: int = 5, rounds: tuple[int, ...] = ROUNDS, sample: int = SAMPLE) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the ``k`` best rows of ``vectors`` for each row of ``queries``."""
    rows = numbered(vectors)
    by_length = trees(rows, sample)
    blocks = cut(rows, by_length, BLOCK)
    chunks = cut(numbered(queries), by_length, CHUNK).withColumnRenamed("block", "chunk").select("chunk", "length", "n", "ids", "vectors")
    summaries = packs(blocks)
    slots = max(1, summaries.count())
    summaries = summaries.withColumn("slot", F.pmod(F.xxhash64("pack"), F.lit(slots)))
    forward = blocks.select("block", F.col("ids").alias("block_ids"), F.col("vectors").alias("block_vectors"))
    query = Window.partitionBy("chunk", "place")
    by_score = query.orderBy(F.desc("score"), "vec_id")
    best = done = None
    for limit in (*rounds, None):
        known = chunks.withColumn("known", F.lit(None).cast("array<struct<place:int,score:long>>"))
        if best is not None:
            kth = best.filter(F.col("rank") == k).groupBy("chunk").agg(F.collect_list(F.struct("place", "score")).alias("known"))
            known = chunks.join(kth, "chunk", "left")  # as many as a chunk has queries
        meeting = known.withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(slots - 1)).cast("array<long>")))
        open_blocks = meeting.join(summaries, ["length", "slot"]).mapInArrow(_bounded, "chunk long, place int, block long, bound double")
        if done is not None:
            open_blocks = open_blocks.join(done, ["chunk", "place", "block"], "left_anti")
        if limit is not None:
            first = F.row_number().over(query.orderBy(F.desc("bound"), "block"))
            open_blocks = stored(open_blocks.withColumn("first", first).filter(F.col("first") <= limit).select("chunk", "place", "block"))
            done = open_blocks if done is None else done.union(open_blocks)
        pairs = open_blocks.groupBy("chunk", "block").agg(F.collect_list("place").alias("places"))
        met = pairs.join(chunks, "chunk").join(forward, "block").select("chunk", "length", "n", "ids", "vectors", "places", "block_ids", "block_vectors")
        found = met.mapInArrow(_scored(k), "chunk long, place int, query_id long, vec_id long, score long")
        if best is not None:
            found = found.unionByName(best.drop("rank"))
        best = stored(found.withColumn("rank", F.row_number().over(by_score)).filter(F.col("rank") <= k))
    return best.select("query_id", "rank", "vec_id", "score")


#: The same rows from DuckDB, for tables small enough to compare every query with every row.
ORACLE_SQL = """
WITH rows AS (
  SELECT vec_id, row_number() OVER () AS n, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pairs AS (
  SELECT q.vec_id AS query_id, q.n, c.vec_id,
    CAST(coalesce(list_sum(list_transform(generate_series(1, len(q.v)), lambda i: q.v[i] * c.v[i])), 0) AS BIGINT) AS score
  FROM rows q JOIN rows c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(q.v) = len(c.v)
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY n ORDER BY score DESC, vec_id) AS rank FROM pairs
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""
