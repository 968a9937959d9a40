"""The prefix trie of conversations, with subtree totals by parallel tree contraction.

Turns are sorted by a range exchange over (conversation, turn), so one conversation of any length is dealt over
tasks; what a task needs from those before it (turns and hash so far of the one conversation it starts in) is one row
a task. A prefix is known by a 127-bit polynomial hash of SHA-256 digests of its turns and its depth. Hashes of a
conversation's own turns are moved onto another beginning by one product each, so conversations that share their
beginnings with a third of all others are never put together.

Subtree totals come from contraction rounds of joins: rake gives every leaf's total to its parent and takes the
leaf away; compress takes out nodes with a single child that have the smallest of three random numbers (parent, own,
child), and keeps for each its child and what the totals of the two differ by. The tree is gone after a number of rounds that
grows with the logarithm of its size, whatever its depth. The rounds are then undone from the last to the first: the
total of a node taken out is that of its child plus the difference.

Turns are ordered by number, null first; those of equal number by role, then by digest. Null role or text counts as
empty, a repeated row as a turn of its own. Rows without a conversation id take no part. Empty input
gives empty output. Texts of any length are hashed whole. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm._shared import stored

PRIME = 2**127 - 1
BASE = int.from_bytes(hashlib.sha256(b"prefixes of conversations").digest()[:15], "big")
#: Conversation ids in one piece of text of the member list.
PIECE = 512


def _id(hashed: int, depth: int) -> bytes:
    return hashed.to_bytes(16, "big") + depth.to_bytes(4, "big")


def _int(data: bytes | None) -> int:
    return int.from_bytes(data or b"", "big")


ROOT = _id(0, 0)


# --- hashes of prefixes ------------------------------------------------------------------------


def _local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Place and prefix hash of each turn, counted from where its conversation begins in this task."""
    part, last, place, hashed = TaskContext.get().partitionId(), None, 0, 0
    for batch in batches:
        places, before, after = [], [], []
        for conversation, digest in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if conversation != last:
                last, place, hashed = conversation, 0, 0
            before.append(hashed.to_bytes(16, "big"))
            place, hashed = place + 1, (hashed * BASE + _int(digest)) % PRIME
            places.append(place)
            after.append(hashed.to_bytes(16, "big"))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array(np.full(len(places), part, np.int32)),
                pa.array(places, pa.int64()),
                pa.array(before, pa.binary()),
                pa.array(after, pa.binary()),
                batch.column(2),
            ],
            ["conv_id", "part", "place", "before", "after", "chars"],
        )


def _carried(carry: dict[tuple[int, int], tuple[int, int]]):
    """Adds what a task's first conversation has in the tasks before it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, parts, places, before, after, chars = (column.to_pylist() for column in batch.columns)
            for k, key in enumerate(zip(ids, parts)):
                if key in carry:
                    turns, hashed = carry[key]
                    step = pow(BASE, places[k] - 1, PRIME)
                    before[k] = ((_int(before[k]) + hashed * step) % PRIME).to_bytes(16, "big")
                    after[k] = ((_int(after[k]) + hashed * step * BASE) % PRIME).to_bytes(16, "big")
                    places[k] += turns
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(places, pa.int64()), pa.array(before, pa.binary()), pa.array(after, pa.binary()), batch.column(5)],
                ["conv_id", "place", "before", "after", "chars"],
            )

    return run


def turns_in_order(conversations: DataFrame) -> DataFrame:
    """conv_id, place (from 1), before, after (hash of the prefix without and with the turn), chars."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    whole = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    turns = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        role.alias("role"),
        F.unhex(F.substring(F.sha2(whole.cast("binary"), 256), 1, 32)).alias("digest"),
        F.length(text).cast("long").alias("chars"),
    )
    order = ["conv_id", "turn", "role", "digest"]
    local = stored(
        turns.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("conv_id", "digest", "chars")
        .mapInArrow(_local, "conv_id long, part int, place long, before binary, after binary, chars long")
    )
    # Conversations in more than one task: at most two ends of each task, so as many rows as tasks.
    ends = local.groupBy("conv_id", "part").agg(F.max("place").alias("turns"), F.max_by("after", "place").alias("after"))
    spread = local.groupBy("conv_id").agg(F.min("part").alias("low"), F.max("part").alias("high")).filter("low < high")
    carry, last, turns_so_far, hashed = {}, None, 0, 0
    for r in sorted(ends.join(spread, "conv_id", "left_semi").collect(), key=lambda r: (r["conv_id"], r["part"])):
        if r["conv_id"] != last:
            last, turns_so_far, hashed = r["conv_id"], 0, 0
        carry[r["conv_id"], r["part"]] = (turns_so_far, hashed)
        hashed = (hashed * pow(BASE, r["turns"], PRIME) + _int(r["after"])) % PRIME
        turns_so_far += r["turns"]
    return local.mapInArrow(_carried(carry), "conv_id long, place long, before binary, after binary, chars long")


# --- nodes -------------------------------------------------------------------------------------


def _moved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of a conversation's own turns, behind the turns it begins with."""
    for batch in batches:
        ids, parents = [], []
        for place, before, after, skipped, taken, own, other in zip(*(batch.column(k).to_pylist() for k in range(1, 8))):
            depth, step = taken + place - skipped, pow(BASE, place - skipped - 1, PRIME)
            apart = (_int(other) - _int(own)) * step % PRIME
            parents.append(_id((_int(before) + apart) % PRIME, depth - 1))
            ids.append(_id((_int(after) + apart * BASE) % PRIME, depth))
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.binary()), pa.array(parents, pa.binary()), batch.column(0), batch.column(8), batch.column(9), batch.column(10)],
            ["id", "parent", "conv_id", "depth", "chars", "ends"],
        )


def memberships(conversations: DataFrame, every: int, most: int) -> DataFrame:
    """A row for each prefix of each rebuilt conversation: id, parent, conv_id, depth, chars of its last turn, ends."""
    turns = stored(turns_in_order(conversations))
    head = F.struct("place", "before", "after", "chars")
    own = turns.groupBy("conv_id").agg(
        F.max("place").alias("turns"), F.array_sort(F.collect_list(F.when(F.col("place") < most, head))).alias("heads")
    )
    own = stored(
        own.withColumn("skipped", F.crc32(F.col("conv_id").cast("string")) % F.lit(most)).withColumn(
            "first", F.col("conv_id") - F.col("conv_id") % F.lit(every)
        )
    )
    firsts = own.filter("conv_id = first").select("first", F.col("heads").alias("first_heads"))
    begun = F.filter(F.coalesce("first_heads", F.array().cast("array<struct<place:bigint,before:binary,after:binary,chars:bigint>>")), lambda h: h["place"] <= F.col("skipped"))
    joined = own.join(firsts, "first", "left").withColumn("begun", begun)
    nothing = F.lit(b"\0" * 16)
    taken = F.size("begun").cast("long")
    known = stored(
        joined.select(
            "conv_id",
            "skipped",
            taken.alias("taken"),
            F.coalesce(F.get(F.col("heads"), F.col("skipped").cast("int") - 1)["after"], nothing).alias("own"),
            F.coalesce(F.get(F.col("begun"), F.size("begun") - 1)["after"], nothing).alias("other"),
            "begun",
            (taken + F.greatest(F.lit(0).cast("long"), F.col("turns") - F.col("skipped"))).alias("length"),
        )
    )
    kinds = "id binary, parent binary, conv_id long, depth long, chars long, ends boolean"
    root = known.select(
        F.lit(ROOT).alias("id"), F.lit(None).cast("binary").alias("parent"), "conv_id", F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("chars"), (F.col("length") == 0).alias("ends")
    )
    depth = lambda d: F.unhex(F.lpad(F.hex(d), 8, "0"))
    beginnings = known.select("conv_id", "length", F.explode("begun").alias("h")).select(
        F.concat("h.after", depth(F.col("h.place"))).alias("id"),
        F.concat("h.before", depth(F.col("h.place") - 1)).alias("parent"),
        "conv_id",
        F.col("h.place").alias("depth"),
        F.col("h.chars").alias("chars"),
        (F.col("length") == F.col("h.place")).alias("ends"),
    )
    at = F.col("taken") + F.col("place") - F.col("skipped")
    rest = (
        turns.join(known.drop("begun"), "conv_id")
        .filter("place > skipped")
        .select("conv_id", "place", "before", "after", "skipped", "taken", "own", "other", at.alias("depth"), "chars", (at == F.col("length")).alias("ends"))
        .mapInArrow(_moved, kinds)
    )
    return root.unionByName(beginnings).unionByName(rest)


# --- digests of members ------------------------------------------------------------------------


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids of a node in a task as pieces of text, in order."""
    held: list[int] = []
    last = None

    def piece() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([last], pa.binary()), pa.array([held[0]]), pa.array([",".join(map(str, held))])], ["id", "first", "text"])

    for batch in batches:
        for node, conversation in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if held and (node != last or len(held) == PIECE):
                yield piece()
                held = []
            last = node
            held.append(conversation)
    if held:
        yield piece()


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    last, running = None, None

    def digest() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([last], pa.binary()), pa.array([running.hexdigest()])], ["id", "ends_sha256"])

    for batch in batches:
        for node, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if node != last:
                if running:
                    yield digest()
                last, running = node, hashlib.sha256(text.encode())
            else:
                running.update(b"," + text.encode())
    if running:
        yield digest()


def ending(members: DataFrame) -> DataFrame:
    """id and digest of the conversations that end there. Only text pieces of a node meet in one task, which streams them."""
    pieces = (
        members.filter("ends")
        .select("id", "conv_id")
        .repartitionByRange("id", "conv_id")
        .sortWithinPartitions("id", "conv_id")
        .mapInArrow(_pieces, "id binary, first long, text string")
    )
    return pieces.repartition("id").sortWithinPartitions("id", "first").select("id", "text").mapInArrow(_digests, "id binary, ends_sha256 string")


# --- contraction -------------------------------------------------------------------------------


def subtree_totals(nodes: DataFrame, columns: list[str]) -> DataFrame:
    """id and the sums of ``columns`` over each node's subtree, of nodes (id, parent, children, *columns), one root or more."""
    edge = [f"edge_{c}" for c in columns]  # what lies between a node and its present parent
    tree = nodes.select("id", "parent", "children", *columns, *(F.lit(0).cast("long").alias(e) for e in edge))
    raked, spliced = [], []
    for step in itertools.count():
        leaf = F.col("children") == 0
        raked.append(tree.filter(leaf).select("id", *columns))
        told = tree.filter("parent IS NOT NULL").select(
            F.col("parent").alias("id"),
            F.when(leaf, 0).otherwise(1).alias("kid"),
            *(F.when(leaf, F.col(c) + F.col(e)).otherwise(0).alias(f"more_{c}") for c, e in zip(columns, edge)),
            F.when(~leaf, F.struct(F.col("id").alias("id"), *edge)).alias("only"),
        )
        told = told.groupBy("id").agg(
            F.sum("kid").alias("kids"), F.max("only").alias("only"), *(F.sum(f"more_{c}").alias(f"more_{c}") for c in columns)
        )
        number = lambda column: F.xxhash64(column, F.lit(step))  # noqa: B023, E731
        single = (F.col("kids") == 1) & F.col("parent").isNotNull()
        smallest = (number(F.col("id")) < number(F.col("parent"))) & (number(F.col("id")) < number(F.col("only.id")))
        inner = stored(
            tree.filter(~leaf)
            .join(told, "id")
            .select(
                "id",
                "parent",
                F.col("kids").alias("children"),
                "only",
                *((F.col(c) + F.col(f"more_{c}")).alias(c) for c in columns),
                *edge,
                F.coalesce(single & smallest, F.lit(False)).alias("out"),
            )
        )
        if inner.isEmpty():
            break
        gone = inner.filter("out")
        spliced.append(gone.select("id", F.col("only.id").alias("child"), *((F.col(c) + F.col(f"only.{e}")).alias(c) for c, e in zip(columns, edge))))
        to_child = gone.select(
            F.col("only.id").alias("id"),
            F.col("parent").alias("new_parent"),
            *((F.col(c) + F.col(e)).alias(f"more_{c}") for c, e in zip(columns, edge)),
        )
        tree = stored(
            inner.filter("NOT out")
            .join(to_child, "id", "left")
            .select(
                "id",
                F.coalesce("new_parent", "parent").alias("parent"),
                "children",
                *columns,
                *((F.col(e) + F.coalesce(f"more_{c}", F.lit(0))).alias(e) for c, e in zip(columns, edge)),
            )
        )
    known = raked[len(spliced)]
    for step in reversed(range(len(spliced))):
        child = known.select(F.col("id").alias("child"), *(F.col(c).alias(f"child_{c}") for c in columns))
        back = spliced[step].join(child, "child").select("id", *((F.col(c) + F.col(f"child_{c}")).alias(c) for c in columns))
        known = stored(known.union(back).union(raked[step]))
    return known


def trie(conversations: DataFrame, every: int = 100, most: int = 6) -> DataFrame:
    """A row for each distinct prefix of the rebuilt conversations, the empty one included.

    Conversation c begins with the first h turns of conversation c - c % ``every``, with h = crc32(decimal c) % ``most``, and
    goes on with its own after its first h; ``most`` = 1 leaves conversations as they are.
    """
    members = stored(memberships(conversations, every, most))
    nodes = members.groupBy("id").agg(
        F.first("parent").alias("parent"),
        F.min("conv_id").alias("conv_id"),
        F.first("depth").alias("depth"),
        F.count(F.lit(1)).alias("n_convs"),
        F.first("chars").alias("chars"),
    )
    nodes = stored(nodes)
    children = nodes.filter("parent IS NOT NULL").groupBy(F.col("parent").alias("id")).agg(F.count(F.lit(1)).alias("children"))
    nodes = stored(
        nodes.join(children, "id", "left")
        .fillna(0, ["children"])
        .withColumn("n_leaves", (F.col("children") == 0).cast("long"))
        .withColumn("saved_tokens", (F.col("n_convs") - 1) * F.col("chars"))
    )
    totals = subtree_totals(nodes.select("id", "parent", "children", "n_leaves", "saved_tokens"), ["n_leaves", "saved_tokens"])
    parents = nodes.select(F.col("id").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    return (
        nodes.drop("n_leaves", "saved_tokens")
        .join(parents, "parent", "left")
        .join(totals, "id")
        .join(ending(members), "id", "left")
        .select(
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            F.col("children").alias("n_children"),
            "n_leaves",
            "saved_tokens",
            F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
        )
    )


#: The same rows from DuckDB, with whole turns as keys; for small tables.
ORACLE_SQL = """
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
), conv AS (
  SELECT conv_id,
    list({'r': role, 't': text} ORDER BY turn NULLS FIRST, role, substr(sha256(concat(length(role), ':', role, text)), 1, 32)) AS own,
    xor(4294967295, list_reduce(
      list_concat([CAST(4294967295 AS BIGINT)], list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
      lambda c, b: list_reduce(
        list_concat([xor(c, b)], CAST(range(8) AS BIGINT[])),
        lambda v, i: CASE WHEN v & 1 = 1 THEN xor(v >> 1, CAST(3988292384 AS BIGINT)) ELSE v >> 1 END))) % 6 AS h
  FROM rows GROUP BY conv_id
), built AS (
  SELECT c.conv_id, list_concat(coalesce(b.own[1:c.h], CAST([] AS STRUCT(r VARCHAR, t VARCHAR)[])), c.own[c.h + 1:]) AS path
  FROM conv c LEFT JOIN conv b ON b.conv_id = c.conv_id - c.conv_id % 100
), member AS (
  SELECT conv_id, d AS depth, path[1:d] AS node, d = len(path) AS ends FROM built, unnest(range(0, len(path) + 1)) AS t(d)
), node AS (
  SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * coalesce(length(node[depth].t), 0) AS saved,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM member GROUP BY node, depth
), kids AS (
  SELECT node[1:depth - 1] AS node, count(*) AS n FROM node WHERE depth > 0 GROUP BY 1
), subtree AS (
  SELECT above.node, sum(CASE WHEN kids.n IS NULL THEN 1 ELSE 0 END) AS n_leaves, sum(above.saved) AS saved_tokens
  FROM (SELECT node AS below, saved, node[1:d] AS node FROM node, unnest(range(0, depth + 1)) AS t(d)) above
  LEFT JOIN kids ON kids.node = above.below GROUP BY above.node
)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, n.n_convs, CAST(coalesce(k.n, 0) AS BIGINT) AS n_children,
  CAST(s.n_leaves AS BIGINT) AS n_leaves, CAST(s.saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM node n JOIN subtree s ON s.node = n.node LEFT JOIN kids k ON k.node = n.node
LEFT JOIN node p ON n.depth > 0 AND p.depth = n.depth - 1 AND p.node = n.node[1:n.depth - 1]
"""
