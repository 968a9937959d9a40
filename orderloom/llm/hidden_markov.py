"""Hidden Markov language model: Baum-Welch over all training documents, exact forward scores.

The vocabulary grows with the corpus, so it is never held in one place. Documents are dealt into
blocks; each block sends its distinct words with their training counts, as packed sorted runs, to
buckets by word hash. A bucket sums the counts of its words over all blocks and answers each run.
With the counts, a block turns its documents into symbols: a word with at least 1/``FREQUENT``
of all training tokens is a symbol of its own (so there are at most ``FREQUENT`` of them); any
other word is one of ``ENDINGS`` classes by its last three bytes. A state emits symbols; a
class emits its words in proportion to their counts less a discount, and the discounts are
the probability of words of that class that training never saw. Over known words and one
unknown word for each class the probabilities sum to one.

Baum-Welch counts of each task are summed over tasks by a shuffle for each iteration. For
training, documents are cut into segments; the score of a document is exact, by the scaled forward
recursion over its whole text.

Null and empty texts are the end token alone. Repeated rows count and are scored each on its own.
Without training documents every symbol is equally likely. Words are told apart by 64-bit hashes.
Other columns are not read.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm._shared import as_bytes, slices, span_hashes, stored, word_places

STATES, ITERATIONS, FREQUENT, ENDINGS, DISCOUNT = 10, 6, 20_000, 2048, 0.7
#: Text bytes of a block, tokens of a training segment, tokens of a batch of segments.
BLOCK_BYTES, SEGMENT, BATCH = 4_000_000, 256, 150_000
#: Hash of the end token, which no word is given.
END = np.uint64(0)


def held_out(doc_id: int) -> bool:
    return zlib.crc32(str(doc_id).encode()) % 7 == 2


def tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Token hashes and ending classes of all texts, each closed by the end token, and where each text begins (one more)."""
    hashes, endings, counts = [], [], []
    for part in slices(texts):
        data, first, last, begins = word_places(texts[part])
        h = span_hashes(data, first, last)
        h[h == END] = 1
        ending = np.zeros(len(first), np.int64)
        for k in range(1, 4):
            ending = ending * 257 + np.where(last - first >= k, data[np.maximum(last - k, 0)].astype(np.int64) + 1, 0)
        ending = ending * 2654435761 % 1000003 % (ENDINGS - 1) + 1
        at = begins[1:]
        hashes.append(np.insert(h, at, END))
        endings.append(np.insert(ending, at, 0))
        counts.append(np.diff(begins) + 1)
    if not counts:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(1, np.int64)
    return np.concatenate(hashes), np.concatenate(endings), np.concatenate(([0], np.cumsum(np.concatenate(counts))))


def word_runs(docs: DataFrame, buckets: int) -> DataFrame:
    """bucket, block, keys, counts, endings: distinct words of each block with their training counts, in runs."""

    def run(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, endings, weights, block = [], [], [], None
        for t in tables:
            block = t.column("block")[0].as_py()
            h, e, begins = tokens(as_bytes(t.column("text")))
            train = np.array([not held_out(d) for d in t.column("doc_id").to_pylist()], np.int64)
            hashes.append(h)
            endings.append(e)
            weights.append(np.repeat(train, np.diff(begins)))
        h, e, w = (np.concatenate(x) for x in (hashes, endings, weights))
        key, at, inverse = np.unique(h, return_index=True, return_inverse=True)
        count, ending = np.bincount(inverse, w).astype(np.int64), e[at].astype(np.uint16)
        edges = np.searchsorted((key >> np.uint64(40)) * np.uint64(buckets) >> np.uint64(24), np.arange(buckets + 1))
        filled = np.flatnonzero(np.diff(edges))
        parts = [[x[edges[k] : edges[k + 1]].tobytes() for k in filled] for x in (key, count, ending)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(filled, pa.int32()), pa.array([block] * len(filled), pa.int32()), *(pa.array(p, pa.binary()) for p in parts)],
            ["bucket", "block", "keys", "counts", "endings"],
        )

    schema = "bucket int, block int, keys binary, counts binary, endings binary"
    return docs.groupBy("block").applyInArrow(run, schema)


def answers(runs: DataFrame, least: float) -> DataFrame:
    """For each run its counts over all blocks; for each bucket its frequent words, and sums by ending class.

    block, bucket, counts; frequent words and their counts; types and tokens of the rest by class; vocabulary.
    """

    def run(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [r for t in tables for r in t.to_pylist()]
        keys = [np.frombuffer(r["keys"], np.uint64) for r in rows]
        counts = np.concatenate([np.frombuffer(r["counts"], np.int64) for r in rows])
        endings = np.concatenate([np.frombuffer(r["endings"], np.uint16) for r in rows])
        key, at, inverse = np.unique(np.concatenate(keys), return_index=True, return_inverse=True)
        total, ending = np.bincount(inverse, counts).astype(np.int64), endings[at]
        edges = np.concatenate(([0], np.cumsum([len(k) for k in keys])))
        often = (total >= least) & (total > 0)
        rest = ~often & (total > 0)
        sums = [np.bincount(ending[rest], w, ENDINGS).astype(np.int64).tobytes() for w in (None, total[rest])]
        n = len(rows)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([*(r["block"] for r in rows), -1], pa.int32()),
                pa.array([rows[0]["bucket"]] * (n + 1), pa.int32()),
                pa.array([*(total[inverse[i:j]].tobytes() for i, j in zip(edges, edges[1:])), total[often].tobytes()], pa.binary()),
                pa.array([None] * n + [key[often].tobytes()], pa.binary()),
                pa.array([None] * n + [sums[0]], pa.binary()),
                pa.array([None] * n + [sums[1]], pa.binary()),
                pa.array([0] * n + [int((total > 0).sum())], pa.int64()),
            ],
            ["block", "bucket", "counts", "frequent", "types", "tokens", "vocabulary"],
        )

    schema = "block int, bucket int, counts binary, frequent binary, types binary, tokens binary, vocabulary long"
    return runs.groupBy("bucket").applyInArrow(run, schema)


def symbols(docs: DataFrame, replies: DataFrame, frequent: np.ndarray, n: int, vocabulary: int) -> DataFrame:
    """Per document its symbols and the parts of its scores that the model does not change."""
    denominator = math.log10(n + vocabulary + 1)

    def encode(left: pa.Table, right: pa.Table) -> pa.Table:
        h, e, begins = tokens(as_bytes(left.column("text").combine_chunks()))
        order = np.argsort(right.column("bucket").to_numpy(), kind="stable")
        parts = right.column("counts").to_pylist()
        total = np.concatenate([np.frombuffer(parts[k], np.int64) for k in order]) if len(h) else np.zeros(0, np.int64)
        count = total[np.unique(h, return_inverse=True)[1]]
        place = np.minimum(np.searchsorted(frequent, h), max(len(frequent) - 1, 0))
        often = frequent[place] == h if len(frequent) else np.zeros(len(h), bool)
        symbol = np.where(often, place, len(frequent) + e + np.where(count > 0, 0, ENDINGS)).astype(np.uint16)
        base = np.log10(count + 1.0) - denominator
        within = np.where(often | (count == 0), 0.0, np.log10(np.maximum(count, 1) - DISCOUNT))
        ids = left.column("doc_id").to_pylist()
        return pa.table(
            {
                "doc_id": left.column("doc_id"),
                "held_out": pa.array([held_out(d) for d in ids], pa.bool_()),
                "n_tokens": pa.array(np.diff(begins), pa.int64()),
                "n_known": pa.array(np.add.reduceat(count > 0, begins[:-1]).astype(np.int64) if len(ids) else [], pa.int64()),
                "base_score": pa.array(np.add.reduceat(base, begins[:-1]) if len(ids) else [], pa.float64()),
                "within": pa.array(np.add.reduceat(within, begins[:-1]) if len(ids) else [], pa.float64()),
                "symbols": pa.array([symbol[i:j].tobytes() for i, j in zip(begins, begins[1:])], pa.binary()),
            }
        )

    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, within double, symbols binary"
    return docs.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(encode, schema)


# --- hidden Markov model ----------------------------------------------------------------------


def padded(sequences: list[np.ndarray], most: int) -> Iterator[tuple[list[int], np.ndarray, np.ndarray]]:
    """Batches of sequences of about one length: (numbers, symbols by step, lengths, longest first)."""
    order = sorted(range(len(sequences)), key=lambda k: -len(sequences[k]))
    begin = 0
    while begin < len(order):
        width = max(1, most // len(sequences[order[begin]]))
        chosen = order[begin : begin + width]
        begin += width
        lengths = np.array([len(sequences[k]) for k in chosen])
        steps = np.zeros((lengths[0], len(chosen)), np.uint16)
        for column, k in enumerate(chosen):
            steps[: lengths[column], column] = sequences[k]
        yield chosen, steps, lengths


def log_likelihoods(sequences: list[np.ndarray], model, most: int = 2_000_000) -> np.ndarray:
    """log10 probability of each sequence by the scaled forward recursion. model: start, transitions, emissions."""
    start, move, emit = model
    out = np.zeros(len(sequences))
    for chosen, steps, lengths in padded(sequences, most):
        total, alpha = np.zeros(len(chosen)), None
        for t in range(len(steps)):
            live = int(np.count_nonzero(lengths > t))
            alpha = (start if alpha is None else alpha[:live] @ move) * emit[steps[t, :live]]
            scale = alpha.sum(1)
            alpha /= scale[:, None]
            total[:live] += np.log10(scale)
        out[chosen] = total
    return out


def expected_counts(sequences: list[np.ndarray], firsts: np.ndarray, model, inner: np.ndarray):
    """Baum-Welch counts (start, transitions, emissions). firsts: which sequences begin a document; inner: state
    distribution where a segment begins inside one."""
    start, move, emit = model
    k = len(start)
    starts, moves, emits = np.zeros(k), np.zeros((k, k)), np.zeros(emit.shape)
    for chosen, steps, lengths in padded(sequences, BATCH):
        depth, width = steps.shape
        alpha, seen = np.zeros((depth, width, k), np.float32), emit[steps]
        alive = np.arange(depth)[:, None] < lengths
        row = np.where(firsts[chosen][:, None], start, inner)
        scales = np.ones((depth, width), np.float32)
        for t in range(depth):
            live = int(np.count_nonzero(alive[t]))
            row = (row[:live] if t == 0 else row[:live] @ move) * seen[t, :live]
            scales[t, :live] = row.sum(1)
            row = row / scales[t, :live, None]
            alpha[t, :live] = row
        beta, carried = np.ones((width, k), np.float32), np.zeros_like(alpha)
        gamma = np.zeros_like(alpha)
        for t in range(depth - 1, -1, -1):
            live = int(np.count_nonzero(alive[t]))
            gamma[t, :live] = alpha[t, :live] * beta[:live]
            message = seen[t, :live] * beta[:live] / scales[t, :live, None]
            carried[t, :live] = message
            beta[:live] = message @ move.T
        if depth > 1:
            moves += alpha[:-1].reshape(-1, k).T @ carried[1:].reshape(-1, k) * move
        starts += gamma[0][firsts[chosen]].sum(0)
        flat = steps[alive].astype(np.int64)
        for state in range(k):
            emits[:, state] += np.bincount(flat, gamma[:, :, state][alive], len(emit))
    return starts, moves, emits


def baum_welch_step(coded: DataFrame, model, inner: np.ndarray, n_symbols: int, parts: int = 16):
    """Counts over all training documents: each task's tables, cut into parts, are summed part by part.

    First over slots of about as many tasks as there are slots, then over the slots, so no sum reads a table
    of every task.
    """
    k = len(inner)
    slots = max(1, math.isqrt(coded.rdd.getNumPartitions()))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [np.zeros(k), np.zeros((k, k)), np.zeros((n_symbols, k))]
        pending, firsts, size = [], [], 0

        def flush():
            nonlocal size
            if pending:
                for into, more in zip(total, expected_counts(pending, np.array(firsts), model, inner)):
                    into += more
            pending.clear()
            firsts.clear()
            size = 0

        for batch in batches:
            for coded_text in batch.column(0).to_pylist():
                s = np.frombuffer(coded_text, np.uint16)
                for begin in range(0, len(s), SEGMENT):
                    pending.append(s[begin : begin + SEGMENT])
                    firsts.append(begin == 0)
                size += len(s)
                if size > 8 * BATCH:
                    flush()
        flush()
        flat = np.concatenate([x.ravel() for x in total]).astype(np.float32)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(range(parts), pa.int32()),
                pa.array([TaskContext.get().partitionId() % slots] * parts, pa.int32()),
                pa.array([p.tobytes() for p in np.array_split(flat, parts)], pa.binary()),
            ],
            ["part", "slot", "counts"],
        )

    def adding(kind):
        def add(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            part, total = None, 0
            for t in tables:
                part = t.column("part")[0].as_py()
                for x in t.column("counts").to_pylist():
                    total = total + np.frombuffer(x, kind).astype(np.float64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([total.tobytes()], pa.binary())], ["part", "counts"]
            )

        return add

    summed = (
        coded.filter("NOT held_out")
        .select("symbols")
        .mapInArrow(count, "part int, slot int, counts binary")
        .groupBy("part", "slot")
        .applyInArrow(adding(np.float32), "part int, counts binary")
        .groupBy("part")
        .applyInArrow(adding(np.float64), "part int, counts binary")
        .collect()
    )
    flat = np.concatenate([np.frombuffer(r["counts"]) for r in sorted(summed)]) if summed else np.zeros(k + k * k + n_symbols * k)
    return flat[:k], flat[k : k + k * k].reshape(k, k), flat[k + k * k :].reshape(n_symbols, k)


def normalised(starts, moves, emits, prior: np.ndarray):
    """Model from counts, smoothed. prior: a distribution over symbols."""
    start = (starts + 1) / (starts.sum() + len(starts))
    move = moves + 1.0
    emit = emits + 50 * prior[:, None]
    return (start).astype(np.float32), (move / move.sum(1, keepdims=True)).astype(np.float32), (emit / emit.sum(0)).astype(np.float32)


def first_model(prior: np.ndarray, states: int, seed: int = 11):
    """Sticky transitions, and the symbols' frequencies with noise that sets the states apart."""
    rng = np.random.default_rng(seed)
    emit = prior[:, None] * np.exp(rng.normal(0, 0.7, (len(prior), states)))
    move = np.full((states, states), 0.1 / states) + 0.9 * np.eye(states)
    return (
        np.full(states, 1 / states, np.float32),
        (move / move.sum(1, keepdims=True)).astype(np.float32),
        (emit / emit.sum(0)).astype(np.float32),
    )


def score(docs: DataFrame, states: int = STATES, iterations: int = ITERATIONS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every document."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(4, -(-size // BLOCK_BYTES))
    dealt = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", F.pmod(F.xxhash64("doc_id", F.length("text")), F.lit(blocks)).cast("int").alias("block")
    )
    runs = stored(word_runs(dealt, max(4, blocks // 8)))

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = sum(int(np.frombuffer(c, np.int64).sum()) for c in batch.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], ["n"])

    n = runs.select("counts").mapInArrow(tally, "n long").agg(F.sum("n")).first()[0] or 0
    replies = stored(answers(runs, max(n / FREQUENT, 1)))
    known = replies.filter("block = -1").select("counts", "frequent", "types", "tokens", "vocabulary")

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sums over buckets of a task; the frequent words are FREQUENT at most over all of them."""
        rows = [r for b in batches for r in b.to_pylist()]
        if rows:
            sums = [sum(np.frombuffer(r[c], np.int64) for r in rows).tobytes() for c in ("types", "tokens")]
            texts = [b"".join(r[c] for r in rows) for c in ("counts", "frequent")]
            yield pa.RecordBatch.from_pylist(
                [dict(zip(("counts", "frequent", "types", "tokens"), (*texts, *sums)), vocabulary=sum(r["vocabulary"] for r in rows))]
            )

    rows = known.mapInArrow(added, known.schema).collect()
    join = lambda c, kind: np.concatenate([np.frombuffer(r[c], kind) for r in rows]) if rows else np.zeros(0, kind)
    frequent, counts = join("frequent", np.uint64), join("counts", np.int64)
    order = np.argsort(frequent)
    frequent, counts = frequent[order], counts[order]
    zero = np.zeros(ENDINGS, np.int64)
    types = sum((np.frombuffer(r["types"], np.int64) for r in rows), zero)
    mass = sum((np.frombuffer(r["tokens"], np.int64) for r in rows), zero)
    vocabulary = sum(r["vocabulary"] for r in rows)

    # Emission symbols: frequent words, then classes; a class's known and unknown words share its emissions.
    f, n_symbols = len(frequent), len(frequent) + ENDINGS
    prior = np.concatenate([counts, mass]) + 0.5
    prior = prior / prior.sum()
    held_back = np.maximum(DISCOUNT * types, 0.5)  # a class never seen has only unknown words
    spread = np.where(types > 0, mass, 0.5)
    constant = np.concatenate([np.zeros(f), -np.log10(spread), np.log10(held_back / spread)])

    coded = stored(symbols(dealt, replies.filter("block >= 0").select("block", "bucket", "counts"), frequent, n, vocabulary))
    wide = lambda emit: np.concatenate([emit, emit[f:]])
    model, inner = first_model(prior, states), np.full(states, 1 / states, np.float32)
    for _ in range(iterations if n else 0):
        start, move, emit = model
        starts, moves, emits = baum_welch_step(coded, (start, move, wide(emit)), inner, n_symbols + ENDINGS)
        emits = np.concatenate([emits[:f], emits[f:n_symbols] + emits[n_symbols:]])
        inner = (emits.sum(0) / emits.sum()).astype(np.float32)
        model = normalised(starts, moves, emits, prior)
    final = (model[0], model[1], wide(model[2]))

    def forward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [np.frombuffer(s, np.uint16) for s in batch.column("symbols").to_pylist()]
            scores = log_likelihoods(texts, final) + batch.column("within").to_numpy() + [constant[s].sum() for s in texts]
            kept = ["doc_id", "held_out", "n_tokens", "n_known", "base_score"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(scores, pa.float64())], [*kept, "score"])

    return coded.mapInArrow(
        forward, "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"
    ).select("doc_id", "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), "base_score", "score")
