"""N-gram Jaccard join on a distributed prefix tree.

A document's set of n-word shingles, as 64-bit hashes in ascending order, is a path. Two sets
of Jaccard similarity t or more differ in at most h = (1-t)/(1+t) (|x|+|y|) shingles. The hash range is
cut into more than h sections: at least one that is not empty is equal in both sets. So there is
one trie for each section, rooted there, and only sets that share a whole section
on their path meet below the same node. Section counts depend on the set size; sizes are dealt into
levels so that two similar sets always share a level.

Shingles that very many sets hold (passages, licence lines) would bring unrelated sets together, where a section
holds nothing else. They are counted over all sets in a table of counters, and the sections are cut from the other
shingles; these differ in no more places than the whole sets do, so the argument holds. A set without enough
sections of them is also stored by the sections of all its shingles.

1. Equal sets are one class, its member the smallest id.
2. Nodes of the tries are found by exchanging packed sorted runs of node keys: within a run and
   then over runs, each node hangs its sets on its smallest one. What comes out is a star for each node,
   never its pairs, so a node that holds a third of all sets is summed up in each task first.
3. Sets connected by stars form a block, which holds every similar partner of its sets. Blocks are
   joined by a path-compressed trie: a traversal carries the overlap with a whole subtree, and leaves it
   when the remaining lengths can no longer reach the threshold, or all its sets are linked already.
4. Large blocks are first linked along their stars, each hub by the tries of its partners, in chunks; what that leaves
   apart is joined by tries over pairs of chunks, so a task never holds more than two chunks. A set goes only to the
   pairs of chunks where it may have a partner. That is found out by sketches, some thirtieth of a set: the parities of its
   shingles dealt over bits. Two sets differ in at least as many shingles as their sketches in bits, so no similar
   pair is lost; the trie decides about the others.

Links carry components, not all pairs: every pair of similar sets ends up in one component, which is the
same as if all links were listed. Documents without words, and null or empty texts, are linked with nothing.
Documents with fewer than n words have their whole sequence as the only shingle. Repeated rows with
one id get the same links if their texts are equal, and stay or go together. Other columns are
kept by ``keep_first`` and not read otherwise. Hashes are 64 bits wide; words are compared by hash.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderloom.llm._shared import BROADCAST_ROWS, as_bytes, mix, pieces, release, shingles, slices, small, stored, tidy, word_hashes
from orderloom.llm.links import components

#: Sets that one trie task holds at most of each of its two chunks.
CHUNK = 2000
#: Node keys that one bucket of the exchange holds about, and that a task sorts at once before it sends them.
BUCKET_KEYS = RUN_KEYS = 400_000
#: Bytes of text that a task works on at once.
SLICE = 1 << 18
#: Hubs that a set of a large block is held against before the tries over chunks.
HUBS = 2
#: Bits of a sketch for each shingle, at least, and chunks of sets whose sketches one task holds as a chunk.
SKETCH_BITS, SKETCH_CHUNKS = 2, 4
#: Counters of popular shingles at most, as a power of two.
COUNTER_BITS = 22


class Similarity:
    """Jaccard >= percent / 100, and the levels of set sizes."""

    def __init__(self, percent: int):
        self.percent = percent
        self.t = percent / 100
        self.ratio = self.t**-2

    def needed(self, x: int, y: int) -> int:
        """Least overlap of similar sets of these sizes."""
        return -(-self.percent * (x + y) // (100 + self.percent))

    def apart(self, x: int, y):
        """Most differing shingles of similar sets of these sizes."""
        return x + y - 2 * self.needed(x, y)

    def level(self, size: int) -> int:
        return int(math.log(size) / math.log(self.ratio) + 1e-9)

    def sections(self, level: int) -> tuple[int, int]:
        """(sections, most differing shingles) of a level: its largest sets differ the most."""
        most = math.ceil(self.ratio ** (level + 1))
        apart = 2 * most * (100 - self.percent) // (100 + self.percent)
        return int((apart + 1) * 1.35) + 3, apart

    def node_keys(self, ordered: np.ndarray, popular: np.ndarray | None = None) -> np.ndarray:
        """Keys of the nodes at which the set is stored: its sections in the level of its size, and in the next
        one where a similar larger set can be there. popular: by the leading bits of a shingle, whether very
        many sets hold it; a wrong mark costs work, not results."""
        size, out = len(ordered), []
        own = self.level(size)
        levels = [own, own + 1] if self.level(size * 100 // self.percent + 1) > own else [own]
        rare = ordered if popular is None else ordered[~popular[ordered >> np.uint64(65 - len(popular).bit_length())]]
        for level in levels:
            m, apart = self.sections(level)
            keys, filled = self._section_keys(rare, level, m)
            out.append(keys[filled])
            if np.count_nonzero(filled) <= apart:
                keys, filled = self._section_keys(ordered, level | 1 << 20, m)
                out.append(keys[filled] if np.count_nonzero(filled) > apart else keys)
        return np.concatenate(out)

    @staticmethod
    def _section_keys(ordered: np.ndarray, tag: int, m: int) -> tuple[np.ndarray, np.ndarray]:
        """Key of each of m sections, and which of them hold shingles."""
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(ordered), dtype=np.uint64)))
        edges = np.searchsorted((ordered >> np.uint64(32)) * np.uint64(m) >> np.uint64(32), np.arange(m + 1))
        count = np.diff(edges)
        key = total[edges[1:]] - total[edges[:-1]]
        return mix(mix(key + count.astype(np.uint64)) + np.uint64(tag << 32) + np.arange(m, dtype=np.uint64)), count > 0


def _sets(docs: DataFrame, n: int, extra: str = "") -> DataFrame:
    """doc_id, size, print (128 bits of the set), and the set itself (``extra``) with its sketch if asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            texts, sets = as_bytes(batch.column(1)), []
            for part in slices(texts, SLICE):
                hashes, begins = word_hashes(texts[part])
                sets += [shingles(hashes[i:j], n) for i, j in zip(begins, begins[1:])]
            prints = [int(np.sum(mix(s))) << 64 | int(np.sum(mix(s ^ np.uint64(0x5851F42D4C957F2D)))) for s in sets]
            columns = [batch.column(0), pa.array(map(len, sets), pa.int64(), size=len(sets)), pa.array([p.to_bytes(16, "big") for p in prints], pa.binary())]
            names = ["doc_id", "size", "print"]
            if extra:
                columns.append(pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())))
                columns.append(pa.array([sketch(s).tobytes() for s in sets], pa.binary()))
                names += [extra, "sketch"]
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = "doc_id long, size long, print binary" + (f", {extra} array<long>, sketch binary" if extra else "")
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(tidy(run), schema)


def popular_shingles(docs: DataFrame, n: int, total: int, parts: int = 16) -> np.ndarray:
    """By leading bits of a shingle's hash, whether its counter stands far above the mean.

    The table has about an eighth as many counters as there are shingles, 2**22 at most: 16 MB in a task, and the same for
    any order of rows. Counters are summed part by part, first over groups of tasks and then over these. Beyond some
    30 million shingles a mark asks for more copies, in proportion; marks decide how much work is done, not what is found.
    """
    bits = int(min(COUNTER_BITS, max(12, math.log2(max(total, 1) / 8))))
    least = max(32, 4 * total // (1 << bits))
    spark = docs.sparkSession
    groups = max(1, math.isqrt(int(spark.conf.get("spark.sql.shuffle.partitions")) // parts))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters = np.zeros(1 << bits, np.uint32)
        for batch in pieces(batches):
            texts = as_bytes(batch.column(0))
            for part in slices(texts, SLICE):
                hashes, begins = word_hashes(texts[part])
                for i, j in zip(begins, begins[1:]):
                    np.add.at(counters, (shingles(hashes[i:j], n) >> np.uint64(64 - bits)).astype(np.int64), 1)
        task = TaskContext.get().partitionId() % groups
        yield from (sums(k, task, part) for k, part in enumerate(np.array_split(counters, parts)))

    def sums(part: int, group: int, counters: np.ndarray) -> pa.RecordBatch:
        arrays = [pa.array([part], pa.int32()), pa.array([group], pa.int32()), pa.array([counters.tobytes()], pa.binary())]
        return pa.RecordBatch.from_arrays(arrays, ["part", "group", "counts"])

    def add(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, part = 0, 0
        for t in tables:
            part = t.column("part")[0].as_py()
            for x in t.column("counts"):
                total = total + np.frombuffer(x.as_buffer(), np.uint32).astype(np.uint64)
        yield sums(part, -1, np.minimum(total, 2**32 - 1).astype(np.uint32))

    def mark(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in add(tables):
            counts = np.frombuffer(t.column("counts")[0].as_buffer(), np.uint32)
            packed = pa.array([np.packbits(counts >= least).tobytes()], pa.binary())
            yield pa.RecordBatch.from_arrays([t.column("part"), t.column("group"), packed], t.schema.names)

    schema = "part int, group int, counts binary"
    first = stored(docs.select("text").mapInArrow(tidy(count), schema).groupBy("part", "group").applyInArrow(add, schema))
    rows = first.groupBy("part").applyInArrow(mark, schema).collect()  # half a megabyte of marks
    release(first)
    if not rows:
        return np.zeros(1 << bits, bool)
    return np.unpackbits(np.frombuffer(b"".join(r["counts"] for r in sorted(rows)), np.uint8)).astype(bool)


def stars(docs: DataFrame, similarity: Similarity, n: int, buckets: int, popular: np.ndarray | None = None) -> DataFrame:
    """a, b: sets that meet at a node, as stars."""

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys: list[np.ndarray] = []
        ids: list[np.ndarray] = []

        def packed():
            if not keys:
                return
            key, doc = np.concatenate(keys), np.concatenate(ids)
            keys.clear()
            ids.clear()
            yield from _hung(key, doc, buckets)

        pending = 0
        for batch in pieces(batches):
            texts, numbers = as_bytes(batch.column(1)), batch.column(0).to_numpy(zero_copy_only=False)
            for part in slices(texts, SLICE):
                hashes, begins = word_hashes(texts[part])
                for doc, i, j in zip(numbers[part], begins, begins[1:]):
                    if i < j:
                        found = similarity.node_keys(shingles(hashes[i:j], n), popular)
                        keys.append(found)
                        ids.append(np.full(len(found), doc, np.int64))
                        pending += len(found)
                if pending > RUN_KEYS:
                    yield from packed()
                    pending = 0
        yield from packed()

    def merged(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, ids = [], []
        for t in tables:
            for k, d in zip(t.column("keys").to_pylist(), t.column("docs").to_pylist()):
                if k is not None:
                    keys.append(np.frombuffer(k, np.uint64))
                    ids.append(np.frombuffer(d, np.int64))
        if keys:
            yield _pairs(*_star(np.concatenate(keys), np.concatenate(ids))[2:])

    sent = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(tidy(runs), "bucket int, keys binary, docs binary, a long, b long")
    sent = stored(sent)
    within = sent.filter("a IS NOT NULL").select("a", "b")
    across = sent.filter("keys IS NOT NULL").groupBy("bucket").applyInArrow(tidy(merged), "a long, b long")
    found = stored(within.union(across).distinct())
    release(sent)
    return found


def _pairs(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    both = np.unique(np.stack([a, b], 1), axis=0) if len(a) else np.zeros((0, 2), np.int64)
    return pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], ["a", "b"])


def _star(key: np.ndarray, doc: np.ndarray):
    """Distinct keys with their smallest id, and (other, smallest) pairs."""
    order = np.lexsort((doc, key))
    key, doc = key[order], doc[order]
    first = np.concatenate(([True], key[1:] != key[:-1]))
    hub = doc[first][np.cumsum(first) - 1]
    other = doc != hub
    return key[first], doc[first], doc[other], hub[other]


def _hung(key: np.ndarray, doc: np.ndarray, buckets: int) -> Iterator[pa.RecordBatch]:
    key, doc, a, b = _star(key, doc)
    place = (key >> np.uint64(40)) * np.uint64(buckets) >> np.uint64(24)
    edges = np.searchsorted(place, np.arange(buckets + 1))
    filled = np.flatnonzero(np.diff(edges))
    pairs = _pairs(a, b)
    none = pa.nulls
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(filled, pa.int32()),
            pa.array([key[edges[k] : edges[k + 1]].tobytes() for k in filled], pa.binary()),
            pa.array([doc[edges[k] : edges[k + 1]].tobytes() for k in filled], pa.binary()),
            none(len(filled), pa.int64()),
            none(len(filled), pa.int64()),
        ],
        ["bucket", "keys", "docs", "a", "b"],
    )
    n = len(pairs)
    if n:
        yield pa.RecordBatch.from_arrays(
            [none(n, pa.int32()), none(n, pa.binary()), none(n, pa.binary()), *pairs.columns], ["bucket", "keys", "docs", "a", "b"]
        )


# --- sketches --------------------------------------------------------------------------------


def sketch(shingled: np.ndarray) -> np.ndarray:
    """Parities of the set's shingles by the last bits of their hash; its width is a power of two."""
    width = 1 << max(6, (SKETCH_BITS * len(shingled) - 1).bit_length())
    places = (mix(shingled.view(np.uint64)) & np.uint64(width - 1)).astype(np.int64)
    return np.packbits(np.bincount(places, minlength=width) & 1).view(np.uint64)


def _folded(sketches: np.ndarray, words: int) -> np.ndarray:
    """The sketches (rows) of the same sets at a smaller width."""
    return np.bitwise_xor.reduce(sketches.reshape(len(sketches), -1, words), axis=1)


def near(left: list[tuple[int, np.ndarray]], right: list[tuple[int, np.ndarray]], similarity: Similarity) -> Iterator[np.ndarray]:
    """For each (size, sketch) of left, the numbers of those of right that may be similar: all similar ones, and some others."""
    by_width: dict[int, list[int]] = {}
    for number in sorted(range(len(right)), key=lambda k: right[k][0]):
        by_width.setdefault(len(right[number][1]), []).append(number)
    groups, folded = {}, {}
    for words, numbers in by_width.items():
        groups[words] = np.array(numbers), np.array([right[k][0] for k in numbers])
        folded[words, words] = np.stack([right[k][1] for k in numbers])
    for size, own in left:
        found = [np.zeros(0, np.int64)]
        for words, (numbers, sizes) in groups.items():
            low = int(np.searchsorted(sizes, -(-similarity.percent * size // 100)))
            high = int(np.searchsorted(sizes, size * 100 // similarity.percent, "right"))
            if low >= high:
                continue
            common = min(words, len(own))
            if (words, common) not in folded:
                folded[words, common] = _folded(folded[words, words], common)
            probe, step = _folded(own[None], common), max(1, (1 << 16) // common)
            for k in range(low, high, step):
                part = slice(k, min(k + step, high))
                differ = np.bitwise_count(folded[words, common][part] ^ probe).sum(axis=1, dtype=np.int64)
                found.append(numbers[part][differ <= similarity.apart(size, sizes[part])])
        yield np.concatenate(found)


def _near_task(similarity: Similarity):
    """Sets of unlinked components that may be similar, once for each pair of their chunks (i, j) where they may."""

    def run(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(tables)
        table = table.take(pa.array(np.lexsort((table.column("doc_id").to_numpy(), table.column("side").to_numpy()))))
        doc, component, chunk, side = (table.column(c).to_numpy() for c in ("doc_id", "component", "chunk", "side"))
        rows = [(n, np.frombuffer(b, np.uint64)) for n, b in zip(table.column("size").to_pylist(), table.column("sketch").to_pylist())]
        begin = int(np.count_nonzero(side == 0))
        left, right = rows[:begin], rows[begin:]
        begin = begin if right else 0
        found, pending = [np.zeros((0, 4), np.int64)], 0
        for x, numbers in enumerate(near(left, right or left, similarity)):
            y = numbers + begin
            y = y[component[y] != component[x]]
            if len(y):
                i, j = np.minimum(chunk[x], chunk[y]), np.maximum(chunk[x], chunk[y])
                own = np.stack([np.full(len(y), x), i, j, (chunk[x] > chunk[y]).astype(np.int64)], 1)
                found += [np.unique(own, axis=0), np.stack([y, i, j, (chunk[y] > chunk[x]).astype(np.int64)], 1)]
                pending += len(y)
                if pending > RUN_KEYS:
                    found, pending = [np.unique(np.concatenate(found), axis=0)], 0
        kept = np.unique(np.concatenate(found), axis=0)
        ids = [pa.array(doc[kept[:, 0]], pa.int64()), pa.array(component[kept[:, 0]], pa.int64())]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(kept), table.column("block")[0].as_py()), pa.int64()), *ids, *(pa.array(kept[:, k], pa.int32()) for k in (1, 2, 3))],
            ["block", "doc_id", "component", "i", "j", "side"],
        )

    return run


# --- trie ------------------------------------------------------------------------------------


class Node:
    """A stretch of shingles that all sets below share, then sets that end here and children by next shingle."""

    __slots__ = ("path", "children", "ends", "low", "high", "sets")

    def __init__(self, path):
        self.path, self.children, self.ends = path, {}, []
        self.low, self.high, self.sets = 1 << 60, 0, []


def _common(x: np.ndarray, y: np.ndarray) -> int:
    n = min(len(x), len(y))
    apart = np.flatnonzero(x[:n] != y[:n])
    return int(apart[0]) if len(apart) else n


def trie(sets: list[np.ndarray]) -> Node:
    root = Node(np.zeros(0, np.int64))
    for number, s in enumerate(sets):
        node, at = root, 0
        while True:
            node.low, node.high = min(node.low, len(s)), max(node.high, len(s))
            node.sets.append(number)
            if at == len(s):
                node.ends.append(number)
                break
            child = node.children.get(int(s[at]))
            if child is None:
                leaf = node.children[int(s[at])] = Node(s[at:])
                leaf.low = leaf.high = len(s)
                leaf.sets, leaf.ends = [number], [number]
                break
            shared = _common(child.path, s[at:])
            if shared < len(child.path):  # split the stretch
                upper = Node(child.path[:shared])
                upper.low, upper.high, upper.sets = child.low, child.high, list(child.sets)
                child.path = child.path[shared:]
                upper.children[int(child.path[0])] = child
                node.children[int(s[at])] = child = upper
            node, at = child, at + shared
    return root


def linked(probe: np.ndarray, root: Node, similarity: Similarity, skip) -> Iterator[int]:
    """Numbers of the trie's sets that are similar to the probe. skip(numbers): nothing to find among them."""
    size = len(probe)
    stack = [(root, 0, 0, 0)]  # node, its depth, the overlap so far, shingles of the probe passed by
    while stack:
        node, depth, overlap, passed = stack.pop()
        if len(node.path):
            lo = np.searchsorted(probe, node.path)
            hit = lo < size
            hit[hit] = probe[lo[hit]] == node.path[hit]
            overlap += int(np.count_nonzero(hit))
            depth += len(node.path)
            passed = max(passed, int(np.searchsorted(probe, node.path[-1], "right")))
        # The best a set below can reach: all that remains of the shorter of the two.
        low, high = max(node.low, -(-similarity.percent * size // 100)), min(node.high, size * 100 // similarity.percent)
        if low > high or overlap + min(size - passed, high - depth) < similarity.needed(size, low):
            continue
        if skip(node.sets):
            continue
        for number in node.ends:
            if 100 * overlap >= similarity.percent * (size + depth - overlap):
                yield number
        stack.extend((child, depth, overlap, passed) for child in node.children.values())


def trie_links(left: list, right: list | None, similarity: Similarity) -> list[tuple[int, int]]:
    """Links (id, id) that join all similar sets of left, or of left with right, into components.

    left, right: (id, component so far, set)."""
    stored_sets = right if right is not None else left
    parent: dict[int, int] = {}

    def find(c: int) -> int:
        while parent.setdefault(c, c) != c:
            parent[c] = parent[parent[c]]
            c = parent[c]
        return c

    def apart(numbers, component):
        own = find(component)
        return {k for k in numbers if find(stored_sets[k][1]) != own}

    sketched = [[(len(s), sketch(s)) for _, _, s in rows] for rows in ([left] if right is None else [left, right])]
    root, out = trie([s for _, _, s in stored_sets]), []
    for (doc, component, probe), close in zip(left, near(sketched[0], sketched[-1], similarity)):
        maybe = apart(close.tolist(), component)
        for number in linked(probe, root, similarity, maybe.isdisjoint) if maybe else ():
            other = stored_sets[number]
            if find(other[1]) != find(component):
                parent[find(other[1])] = find(component)
                out.append((doc, other[0]))
                maybe.intersection_update(apart(maybe, component))
    return out


def _chunk_task(similarity: Similarity):
    def run(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left, right = [], []
        for t in tables:
            columns = [t.column(c) for c in ("doc_id", "component", "side")]
            sets = t.column("shingles")
            for k, (doc, component, side) in enumerate(zip(*(c.to_pylist() for c in columns))):
                (left if side == 0 else right).append((doc, component, np.asarray(sets[k].values, np.int64)))
        for rows in (left, right):
            rows.sort(key=lambda r: r[0])
        found = trie_links(left, right if right else None, similarity)
        yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)], ["a", "b"])

    return run


def _pairs_of_chunks(of: int):
    """(i, j, side) of the tasks that a row goes to, of all pairs of chunks of ``of`` chunks each, but for two of the largest component."""
    in_top = F.col("chunk") >= F.col("loose")
    loose, fixed = (F.ceil(F.col(c) / of).cast("int") for c in ("loose", "fixed"))
    own = F.floor(F.when(in_top, F.col("chunk") - F.col("loose")).otherwise(F.col("chunk")) / of).cast("int")
    zero = F.lit(0)
    task = lambda i, j, side: F.struct(i.cast("int").alias("i"), j.cast("int").alias("j"), F.lit(side).alias("side"))
    span = lambda low, high, f: F.when(low <= high, F.transform(F.sequence(low, high), f)).otherwise(F.array())
    return F.when(in_top, span(zero, loose - 1, lambda i: task(i, loose + own, 1))).otherwise(
        F.concat(
            span(own, own, lambda i: task(i, i, 0)),
            span(own + 1, loose - 1, lambda j: task(own, j, 0)),
            span(zero, own - 1, lambda i: task(i, own, 1)),
            span(loose, loose + fixed - 1, lambda j: task(own, j, 0)),
        )
    )


def join(docs: DataFrame, percent: int, n: int, chunk: int = CHUNK) -> DataFrame:
    """doc_id, n_shingles, component_id, class_id of every document."""
    similarity = Similarity(percent)
    sized = stored(_sets(docs, n))
    classes = sized.filter("size > 0").groupBy("print").agg(F.min("doc_id").alias("class_id"), F.max("size").alias("class_size"))
    classes = stored(classes)
    total = classes.agg(F.count(F.lit(1)), F.sum("class_size")).first()
    buckets = max(4, math.ceil((total[1] or 0) * (1 - similarity.t) * 2.5 / BUCKET_KEYS))
    reps = classes.select(F.col("class_id").alias("doc_id"))
    few = total[0] <= BROADCAST_ROWS
    texts = docs.select(F.col("doc_id").cast("long"), "text")
    own = texts.join(F.broadcast(reps) if few else reps, "doc_id", "left_semi")
    popular = popular_shingles(own, n, total[1] or 0)
    edges = stars(own, similarity, n, buckets, popular)
    blocks = stored(components(edges).withColumnsRenamed({"id": "doc_id", "component": "block"}))
    met = blocks.count()

    ids = blocks.select("doc_id")
    met_texts = texts.join(F.broadcast(ids) if met <= BROADCAST_ROWS else ids, "doc_id", "left_semi")
    # The shingles come out of a Python task: signed, so ordered as signed numbers.
    sets = _sets(met_texts, n, "shingles").select("doc_id", "size", F.array_sort("shingles").alias("shingles"), "sketch")
    repeated = not sized.groupBy("doc_id").count().filter("count > 1").isEmpty()
    sets = stored(sets.dropDuplicates(["doc_id"]) if repeated else sets)

    # Large blocks: links along the stars. A set is held against the hubs with the most partners among its own, so it is sent
    # as often as that and not once for each of its nodes; a hub goes once to each chunk of its partners, and probes
    # their trie. This only saves work below: what it leaves apart meets there.
    counted = blocks.groupBy("block").agg(F.count(F.lit(1)).alias("members"))
    large = stored(counted.filter(F.col("members") > chunk).select("block"))
    in_large = blocks.join(large, "block", "left_semi").select("doc_id")
    candidates = edges.join(in_large.withColumnRenamed("doc_id", "a"), "a", "left_semi")
    partners = candidates.groupBy("b").agg(F.count(F.lit(1)).alias("partners"))
    nearest = Window.partitionBy("a").orderBy(F.desc("partners"), "b")
    held = candidates.join(partners, "b").withColumn("nearest", F.row_number().over(nearest)).filter(F.col("nearest") <= HUBS)
    chunks = F.ceil(F.col("partners") / chunk).cast("int")
    star = stored(held.select("a", "b", F.pmod(F.xxhash64("a"), chunks).cast("int").alias("i")))
    roles = [star.select("b", "i", F.col("a").alias("doc_id"), F.lit(1).alias("side")), star.select("b", "i", F.col("b").alias("doc_id"), F.lit(0).alias("side")).distinct()]
    met_there = stored(roles[0].union(roles[1]).withColumn("component", F.col("doc_id")))
    whole_sets = sets.select("doc_id", "shingles")
    along = stored(whole_sets.join(small(met_there), "doc_id").groupBy("b", "i").applyInArrow(_chunk_task(similarity), "a long, b long"))
    release(met_there, star)
    reached = components(along).withColumnsRenamed({"id": "doc_id", "component": "reached"})
    members = blocks.join(reached, "doc_id", "left").select("doc_id", "block", F.coalesce("reached", "doc_id").alias("component"))
    members = stored(members)

    # Tasks: a block is one, or pairs of chunks. The largest component of a block needs no join with itself.
    parts = members.groupBy("block", "component").agg(F.count(F.lit(1)).alias("n"))
    tops = parts.groupBy("block").agg(
        F.max_by("component", F.struct("n", "component")).alias("top"), F.max("n").alias("top_n"), F.sum("n").alias("n")
    )
    tops = stored(
        tops.filter("top_n < n").select(
            "block",
            "top",
            F.when(F.col("n") <= chunk, 1).otherwise(F.ceil((F.col("n") - F.col("top_n")) / chunk)).cast("int").alias("loose"),
            F.when(F.col("n") <= chunk, 0).otherwise(F.ceil(F.col("top_n") / chunk)).cast("int").alias("fixed"),
        )
    )
    spread = F.pmod(F.xxhash64("doc_id"), F.col("loose")).cast("int")
    spread_top = F.pmod(F.xxhash64("doc_id"), F.greatest("fixed", F.lit(1))).cast("int")
    in_top = (F.col("component") == F.col("top")) & (F.col("fixed") > 0)
    placed = members.join(tops, "block").withColumn("chunk", F.when(in_top, F.col("loose") + spread_top).otherwise(spread))
    placed = stored(placed.select("doc_id", "block", "component", "chunk", "loose", "fixed"))
    zero = F.lit(0).cast("int")
    whole = placed.filter("loose + fixed = 1").select("block", "doc_id", "component", zero.alias("i"), zero.alias("j"), zero.alias("side"))
    # Blocks of several chunks: only the sketches meet in all pairs of (larger) chunks.
    several = placed.filter("loose + fixed > 1")
    close = (
        sets.select("doc_id", "size", "sketch")
        .join(small(several), "doc_id")
        .withColumn("task", F.explode(_pairs_of_chunks(SKETCH_CHUNKS)))
        .select("doc_id", "block", "component", "chunk", "size", "sketch", "task.*")
        .groupBy("block", "i", "j")
        .applyInArrow(tidy(_near_task(similarity)), "block long, doc_id long, component long, i int, j int, side int")
    )
    dealt = whole.union(close)
    dealt = small(stored(dealt))
    found = stored(whole_sets.join(dealt, "doc_id").groupBy("block", "i", "j").applyInArrow(_chunk_task(similarity), "a long, b long"))
    release(sets)
    joined = components(along.union(found)).withColumnsRenamed({"id": "class_id", "component": "joined"})
    of_class = stored(classes.join(joined, "class_id", "left").select("print", "class_id", F.coalesce("joined", "class_id").alias("component")))
    return (
        sized.join(F.broadcast(of_class) if few else of_class, "print", "left")
        .select(
            "doc_id",
            F.col("size").alias("n_shingles"),
            F.coalesce("component", "doc_id").alias("component_id"),
            F.coalesce("class_id", "doc_id").alias("class_id"),
        )
    )


def keep_first(docs: DataFrame, percent: int = 80, n: int = 5) -> DataFrame:
    """The documents that are the smallest id of their component, all columns kept."""
    first = stored(join(docs, percent, n).filter("component_id = doc_id").select("doc_id").distinct())
    kept = F.broadcast(first) if first.count() <= BROADCAST_ROWS else first
    return docs.join(kept, "doc_id", "left_semi")
