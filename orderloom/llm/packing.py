"""Packing token sequences by cutting-stock column generation.

Documents become token ids and a closing id 0. Whole sequences are cut off a document's
front; what is left (shorter than a sequence) is to be packed. The histogram of these
lengths is the demand of a cutting-stock problem: its linear program chooses how often each
pattern (a multiset of lengths that fits) is used, columns are priced by a knapsack dynamic
program over the capacity, and the solution is rounded down, then up where the rest of the
demand still holds a pattern in full. Rests are ranked within their length, and rank by
rank they take the places of the patterns. Patterns that waste more than ``SLACK`` tokens are not
used: what has no place is chained in order and cut at each full sequence, and the last,
partial sequence at powers of two, which need no padding.

The histogram has fewer rows than a sequence has tokens, whatever the input; ranks and the
chain are counted in slices by hash, so no length, however common, lands in one task.

Ids are those of ``tokenizers`` on the published vocabulary, added tokens such as <|endoftext|> included.
Texts without added tokens and very long blank runs have the same ids by ``tiktoken``, which is faster.

Null and empty texts are the closing id alone. Repeated rows are packed each on its own. Empty
input gives no pieces. Other columns are not read. The same input gives the same pieces; their
sequence ids depend on how rows were dealt to tasks.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderloom.llm._shared import BROADCAST_ROWS, stored, tidy

SIZE, SLACK, CLOSING = 1024, 8, 0
SLICES = 128
#: White space characters in a row from which on a text is not given to tiktoken.
BLANKS = 1000
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, ids binary"


def vocabulary(name: str = "byte_bpe_50k.tiktoken") -> str:
    """Place of the ranks of the byte-level vocabulary (the same ids as byte_bpe_50k.json)."""
    import public_tokenizers

    return public_tokenizers.path(name)


def tokenizer(path: str | None = None):
    """text -> ids, added tokens read as plain text."""
    import base64

    import public_tokenizers
    import tiktoken

    with open(path or vocabulary(), "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


def encoder(path: str | None = None) -> Callable[[str], list[int]]:
    """text -> ids as ``tokenizers`` gives them on the JSON file beside the ranks, without special tokens put around."""
    from tokenizers import Tokenizer

    published = Tokenizer.from_file((path or vocabulary()).removesuffix(".tiktoken") + ".json")
    added = [re.escape(token.content) for token in published.get_added_tokens_decoder().values()]
    # tiktoken reads added tokens as text, and its pattern overflows the stack on very long blank runs.
    slow = re.compile("|".join([*added, rf"\s{{{BLANKS}}}"]))
    fast = tokenizer(path)

    def ids(text: str) -> list[int]:
        return published.encode(text, add_special_tokens=False).ids if slow.search(text) else fast(text)

    return ids


def crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64()] * 5 + [pa.binary()]
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kinds[k]) for k in range(6)], names)


def tokenized(docs: DataFrame, size: int = SIZE, path: str | None = None) -> DataFrame:
    """Pieces of all documents: whole sequences, and the rest with its ids."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        to_ids = encoder(path)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = np.array([*to_ids(text or ""), CLOSING], np.uint32)
                for start in range(0, len(ids), size):
                    part = ids[start : start + size]
                    rest = part.astype("<u4").tobytes() if len(part) < size else None
                    rows.append((doc_id, start, len(part), crc(part), len(ids), rest))
                if len(rows) >= 2000:
                    yield _batch(rows)
                    rows = []
            yield _batch(rows)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(tidy(encode), SCHEMA)


# --- cutting stock ---------------------------------------------------------------------------


def best_patterns(lengths: np.ndarray, value: np.ndarray, size: int, most: int = 60) -> tuple[float, list[np.ndarray]]:
    """Knapsack by dynamic programming over the capacity: the best value, and good patterns, the best first.

    One table serves all: for each length, the best pattern that holds it.
    """
    best, item = np.zeros(size + 1), np.full(size + 1, -1)
    counts = np.searchsorted(lengths, np.arange(size + 1), "right")
    for c in range(1, size + 1):
        best[c] = best[c - 1]
        if n := counts[c]:
            gain = value[:n] + best[c - lengths[:n]]
            k = gain.argmax()
            if gain[k] > best[c] + 1e-12:
                best[c], item[c] = gain[k], k
    fits = counts[size]
    holding = value[:fits] + best[size - lengths[:fits]]
    patterns = []
    for k in np.argsort(-holding, kind="stable")[:most]:
        pattern = np.zeros(len(lengths))
        pattern[k], c = 1, size - lengths[k]
        while c > 0:
            if item[c] < 0:
                c -= 1
            else:
                pattern[item[c]] += 1
                c -= lengths[item[c]]
        patterns.append(pattern)
    return float(best[size]), patterns


def first_patterns(lengths: np.ndarray, demand: np.ndarray, size: int) -> list[tuple[int, np.ndarray, float]]:
    """(length used up, pattern, uses) to start from.

    Again and again the longest length left gets the lengths that fill its sequence up, exactly where one or
    two do, else the longest that fit; the pattern is used until one of its lengths is used up. That length
    occurs in no later pattern, so the patterns are independent.
    """
    m, rest = len(lengths), demand.astype(float)
    where = np.full(size + 1, -1)
    where[lengths] = np.arange(m)
    found, open_ = [], np.ones(m, bool)
    while open_.any():
        k = int(np.flatnonzero(open_)[-1])
        pattern, room = np.zeros(m), size - int(lengths[k])
        pattern[k] = 1
        if room and where[room] >= 0 and open_[where[room]]:
            pattern[where[room]] += 1
            room = 0
        elif room:
            left = np.flatnonzero(open_[: np.searchsorted(lengths, room)])
            other = where[room - lengths[left]]
            pairs = left[(other >= 0) & open_[other]]
            if len(pairs):
                pattern[pairs[-1]] += 1
                pattern[where[room - lengths[pairs[-1]]]] += 1
                room = 0
        while room:
            left = np.flatnonzero(open_[: np.searchsorted(lengths, room, "right")])
            if not len(left):
                break
            pattern[left[-1]] += 1
            room -= int(lengths[left[-1]])
        used = np.flatnonzero(pattern)
        ratio = rest[used] / pattern[used]
        pivot = int(used[np.argmin(ratio)])
        found.append((pivot, pattern, float(ratio.min())))
        rest[used] -= ratio.min() * pattern[used]
        open_[pivot] = False
        open_ &= rest > 1e-9
    return found


def solve(lengths: np.ndarray, demand: np.ndarray, size: int, gap: float = 1e-3, steps: int = 200):
    """Patterns (rows) and their uses in the linear program, by column generation.

    Revised simplex on the inverse of the basis. It ends when no pattern prices in, when the uses are within
    ``gap`` of a lower bound (all tokens, or the dual value that pricing gives), or after ``steps``
    pricing rounds. Each of its states is feasible.
    """
    m = len(lengths)
    basis, x = np.diag((size // lengths).astype(float)), np.zeros(m)  # each length alone, until its pattern enters
    inverse = np.diag(1 / np.diag(basis))

    def enter(pattern: np.ndarray, step: np.ndarray, out: int) -> None:
        pivot = inverse[out] / step[out]
        for row in np.flatnonzero(step):
            inverse[row] -= step[row] * pivot
        inverse[out] = pivot
        basis[:, out] = pattern

    for out, pattern, uses in first_patterns(lengths, demand, size):
        enter(pattern, pattern / (size // lengths), out)  # none of its lengths is used up before
        x[out] = uses
    floor = max(1.0, lengths @ demand / size)
    for _ in range(steps):
        price = inverse.sum(0)
        worth, patterns = best_patterns(lengths, price, size)
        if worth <= 1 + 1e-9 or x.sum() <= max(floor, price @ demand / worth) * (1 + gap):
            break
        for pattern in patterns:
            if price @ pattern <= 1 + 1e-9:  # prices move with each column
                continue
            step = inverse @ pattern
            grows = step > 1e-9
            if not grows.any():
                continue
            ratio = np.full(m, np.inf)
            ratio[grows] = np.maximum(x[grows], 0) / step[grows]
            out = int(np.argmin(ratio))
            x = x - ratio[out] * step
            x[out] = ratio[out]
            enter(pattern, step, out)
            price = inverse.sum(0)
    return basis.T, np.maximum(x, 0)


def rounded(patterns: np.ndarray, uses: np.ndarray, lengths: np.ndarray, demand: np.ndarray, size: int, slack: int):
    """Whole uses of each pattern, none beyond the demand, none of patterns that waste more than ``slack``."""
    tight = patterns @ lengths >= size - slack
    whole = np.where(tight, np.floor(uses + 1e-9), 0).astype(int)
    rest = demand - whole @ patterns
    for k in np.argsort(-(uses - np.floor(uses)), kind="stable"):
        while tight[k] and (patterns[k] <= rest).all():
            whole[k] += 1
            rest = rest - patterns[k]
    for k in np.flatnonzero(whole):  # the inverse is inexact: never more than there is
        while (rest < 0).any() and whole[k] and (patterns[k] * (rest < 0)).any():
            whole[k] -= 1
            rest = rest + patterns[k]
    return whole


def places(histogram: dict[int, int], size: int = SIZE, slack: int = SLACK) -> tuple[list[tuple[int, ...]], int]:
    """Places of patterns as (length, first rank, end rank, copies, first sequence, offset), and the number of sequences."""
    if not histogram:
        return [], 0
    lengths = np.array(sorted(histogram))
    demand = np.array([histogram[n] for n in lengths], float)
    patterns, uses = solve(lengths, demand, size)
    whole = rounded(patterns, uses, lengths, demand, size, slack)
    found, rank, sequence = [], dict.fromkeys(lengths.tolist(), 0), 0
    for pattern, n in zip(patterns.astype(int), whole.tolist()):
        offset = 0
        for k in np.flatnonzero(pattern) if n else ():
            length, copies = int(lengths[k]), int(pattern[k])
            found.append((length, rank[length], rank[length] + copies * n, copies, sequence, offset))
            rank[length] += copies * n
            offset += copies * length
        sequence += n
    return found, sequence


def chain_ends(total: int, size: int) -> list[int]:
    """Ends, within the last partial sequence, of its parts: descending powers of two."""
    ends, at = [], total - total % size
    for bit in reversed(range(size.bit_length())):
        if total % size >> bit & 1:
            at += 1 << bit
            ends.append(at)
    return ends


def pack(docs: DataFrame, size: int = SIZE, slack: int = SLACK, path: str | None = None) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset of every piece."""
    spark = docs.sparkSession
    pieces = stored(tokenized(docs, size, path).withColumn("row", F.monotonically_increasing_id()))
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    rests = pieces.filter(F.col("length") < size).withColumn("slice", F.pmod(F.xxhash64("row"), F.lit(SLICES)))

    counted = rests.groupBy("length", "slice").agg(F.count(F.lit(1)).alias("rows"))
    histogram = {r["length"]: r["rows"] for r in counted.groupBy("length").agg(F.sum("rows").alias("rows")).collect()}
    slots, sequences = places(histogram, size, slack)
    before = Window.partitionBy("length").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = counted.select("length", "slice", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("first"))
    starts = F.broadcast(starts) if size * SLICES <= BROADCAST_ROWS else starts
    ranked = (
        rests.drop("ids")
        .withColumn("nth", F.row_number().over(Window.partitionBy("length", "slice").orderBy("row")) - 1)
        .join(starts, ["length", "slice"])
        .withColumn("rank", F.col("first") + F.col("nth"))
    )
    slot = spark.createDataFrame(
        slots, "length long, lo long, hi long, copies long, base long, at long"
    )  # at most one row for each entry of the basis: bounded by the sequence size
    ranked = stored(
        ranked.join(F.broadcast(slot), (ranked["length"] == slot["length"]) & (F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi")), "left")
        .drop(slot["length"])
        .select(*columns, "row", "slice", "copies", "base", "at", (F.col("rank") - F.col("lo")).alias("nth"))
    )
    placed = ranked.filter("base IS NOT NULL").select(
        *columns,
        (F.col("base") + F.expr("nth div copies")).alias("sequence_id"),
        (F.col("at") + F.col("nth") % F.col("copies") * F.col("length")).alias("offset"),
    )

    # What has no place: one chain, cut where sequences are full.
    loose = ranked.filter("base IS NULL").select("row", "slice", "length")
    lengths = loose.groupBy("slice").agg(F.sum("length").alias("tokens"), F.count(F.lit(1)).alias("rows"))
    totals = lengths.collect()  # SLICES rows at most
    total = sum(r["tokens"] for r in totals)
    at = dict.fromkeys(range(SLICES), 0)
    begin = 0
    for r in sorted(totals):
        at[r["slice"]], begin = begin, begin + r["tokens"]
    first = F.element_at(F.array(*(F.lit(at[k]).cast("long") for k in range(SLICES))), (F.col("slice") + 1).cast("int"))
    running = F.sum("length").over(Window.partitionBy("slice").orderBy("row").rowsBetween(Window.unboundedPreceding, 0))
    loose = loose.select("row", (first + running - F.col("length")).alias("chain"))
    if sum(r["rows"] for r in totals) <= BROADCAST_ROWS:
        loose = F.broadcast(loose)
    ends = chain_ends(total, size)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, start, tokens, ids, chain in zip(*(c.to_pylist() for c in batch.columns)):
                ids = np.frombuffer(ids, "<u4")
                inner = {*range(chain - chain % size + size, min(chain + len(ids), total - total % size + 1), size), *ends}
                edges = [chain, *sorted(e for e in inner if chain < e < chain + len(ids)), chain + len(ids)]
                for a, b in pairwise(edges):
                    part = ids[a - chain : b - chain]
                    tail = total - total % size
                    nth = a // size if a < tail else tail // size + sum(e <= a for e in ends)
                    begun = a - a % size if a < tail else max([tail, *(e for e in ends if e <= a)])
                    rows.append((doc_id, start + a - chain, b - a, crc(part), tokens, sequences + nth, a - begun))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in rows], pa.int64()) for k in range(7)], [*columns, "sequence_id", "offset"]
            )

    chained = (
        rests.drop("slice")
        .join(loose, "row")
        .select("doc_id", "start", "doc_tokens", "ids", "chain")
        .mapInArrow(cut, ", ".join(f"{c} long" for c in [*columns, "sequence_id", "offset"]))
    )
    packed = sequences + -(-total // size) + len(ends)
    whole = pieces.filter(F.col("length") == size).select(
        *columns, (F.col("row") + packed).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    return whole.unionByName(placed).unionByName(chained)
