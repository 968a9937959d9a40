"""Quality by attention-based multiple-instance learning.

A document is a bag of passages of 64 words. Every passage is encoded (shares of byte-class
pairs and of hashed words, and a few ratios, through one tanh layer), gated attention weighs
the passages, and a logistic unit scores the weighted representation. Labels belong to
documents only; attention learns which passages carry them.

Trained by Adam on at most ``SAMPLE`` labelled documents, those with the smallest hash of
their id among rows whose crc32(doc_id as text) mod 5 is not 0, and on every passage of each. Together they have
at most ``BAGS`` passages: a document that would go beyond is left out of the sample as a whole. Scoring reads every passage of every document and never sees lang, source, labels or ids.

Null and empty texts are one empty passage, and get its score. A score depends on the text alone, whatever stands beside
it, and is rounded to five digits, so that repeated rows score alike. Texts of any length are read whole; an empty table gives an empty one. Of
several labels of a document the largest counts. Without labels of both classes every score is
0.5. Other columns are kept by ``keep`` and not read otherwise.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm._shared import as_bytes, slices, stored, tidy, word_hashes

SAMPLE, BAGS, PASSAGE = 4000, 256_000, 64
THRESHOLD = 0.3
#: Bytes of text that a task works on at once.
SLICE = 1 << 18
CLASSES, BUCKETS = 16, 128
WIDTH = CLASSES * CLASSES + BUCKETS + 4

_CLASS = np.full(256, 15, np.uint8)  # other punctuation
_CLASS[list(b" \t")] = 0
_CLASS[list(b"\n\r\x0b\x0c")] = 1
_CLASS[list(b"abcdefghijklmnopqrstuvwxyz")] = 2
_CLASS[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ")] = 3
_CLASS[list(b"0123456789")] = 4
_CLASS[128:] = 5
for _k, _c in enumerate((b".", b",", b"!?", b"|", b"#*", b"$%&", b"'\"", b"-_", b"<>/=")):
    _CLASS[list(_c)] = 6 + _k


def passages(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages (float32), and where each text's passages begin (one more)."""
    hashes, begins = word_hashes(texts)
    counts = np.maximum(1, -(-np.diff(begins) // PASSAGE))
    first = np.concatenate(([0], np.cumsum(counts)))
    n = int(first[-1])
    doc_of_word = np.repeat(np.arange(len(texts)), np.diff(begins))
    passage = first[doc_of_word] + (np.arange(len(hashes)) - begins[doc_of_word]) // PASSAGE
    # A byte belongs to the passage of its text's last word that began before it, or to the first one; pairs lie within a text.
    data = np.frombuffer(b" ".join([*texts, b""]), np.uint8)
    kind = _CLASS[data].astype(np.int64)
    inner = kind > 1
    word = np.cumsum(inner & ~np.concatenate(([False], inner[:-1]))) - 1
    sizes = np.array([len(t) + 1 for t in texts], np.int64)
    text = np.repeat(np.arange(len(texts)), sizes)
    own = word >= begins[text]
    owner = np.where(own, passage[np.where(own, word, 0)] if len(passage) else 0, first[text])
    last = np.cumsum(sizes) - 1  # the spaces between the texts
    paired = np.ones(len(data), bool)
    paired[last] = False
    paired[np.maximum(last - 1, 0)] = False  # the last byte of a text; of an empty one, the space before it
    at = np.flatnonzero(paired[:-1]) if len(data) else np.zeros(0, np.int64)
    out = np.zeros((n, WIDTH), np.float32)
    pair = owner[at] * CLASSES**2 + kind[at] * CLASSES + kind[at + 1]
    pairs = np.bincount(pair, minlength=n * CLASSES**2).reshape(n, -1)
    size = np.maximum(1, pairs.sum(1, keepdims=True))
    out[:, : CLASSES**2] = 4 * np.sqrt(pairs / size)
    bucket = np.bincount(passage * BUCKETS + (hashes % np.uint64(BUCKETS)).astype(np.int64), minlength=n * BUCKETS)
    number = np.bincount(passage, minlength=n)
    words = np.maximum(1, number)[:, None]
    out[:, CLASSES**2 : -4] = np.sqrt(bucket.reshape(n, -1) / words)
    order = np.lexsort((hashes, passage))
    p, h = passage[order], hashes[order]
    new = np.ones(len(p), bool)
    new[1:] = (p[1:] != p[:-1]) | (h[1:] != h[:-1])
    out[:, -4] = np.bincount(p[new], minlength=n) / words[:, 0]
    out[:, -3] = np.minimum(4, size[:, 0] / words[:, 0] / 6)
    out[:, -2] = number / PASSAGE
    out[:, -1] = 1
    return out, first


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def attend(model: dict[str, np.ndarray], x: np.ndarray, first: np.ndarray):
    """Score of each bag, and what the gradient needs. first: where the bags begin (one more)."""
    h = np.tanh(x @ model["W"])
    t, g = np.tanh(h @ model["V"]), _sigmoid(h @ model["U"])
    e = (t * g) @ model["w"]
    bag = np.repeat(np.arange(len(first) - 1), np.diff(first))
    a = np.exp(e - np.maximum.reduceat(e, first[:-1])[bag])
    a /= np.add.reduceat(a, first[:-1])[bag]
    z = np.add.reduceat(a[:, None] * h, first[:-1])
    return _sigmoid(z @ model["c"] + model["d"]), (h, t, g, a, z, bag)


def fit(bags: list[np.ndarray], labels: np.ndarray, hidden: int = 24, gate: int = 12, epochs: int = 12, seed: int = 7):
    """Model trained by Adam on the cross-entropy of the bags' labels."""
    rng = np.random.default_rng(seed)
    shapes = {"W": (WIDTH, hidden), "V": (hidden, gate), "U": (hidden, gate), "w": (gate,), "c": (hidden,), "d": (1,)}
    model = {k: rng.normal(0, 1 / np.sqrt(s[0]), s).astype(np.float32) for k, s in shapes.items()}
    model["d"][:] = np.log((labels.sum() + 1) / (len(labels) - labels.sum() + 1))
    moments = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in model.items()}
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(bags))
        for begin in range(0, len(order), 32):
            chosen = order[begin : begin + 32]
            x = np.concatenate([bags[k] for k in chosen])
            first = np.concatenate(([0], np.cumsum([len(bags[k]) for k in chosen])))
            p, (h, t, g, a, z, bag) = attend(model, x, first)
            out = (p - labels[chosen]) / len(chosen)
            dz = out[:, None] * model["c"]
            along = (dz[bag] * h).sum(1)
            de = a * (along - np.add.reduceat(a * along, first[:-1])[bag])
            dt, dg = de[:, None] * model["w"] * g * (1 - t * t), de[:, None] * model["w"] * t * g * (1 - g)
            dh = (a[:, None] * dz[bag] + dt @ model["V"].T + dg @ model["U"].T) * (1 - h * h)
            grads = {"W": x.T @ dh, "V": h.T @ dt, "U": h.T @ dg, "w": (t * g).T @ de, "c": z.T @ out, "d": out.sum(keepdims=True)}
            step += 1
            for k, grad in grads.items():
                m, v = moments[k]
                grad = grad + 1e-4 * model[k]
                m += 0.1 * (grad - m)
                v += 0.001 * (grad * grad - v)
                model[k] -= (0.004 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return model


def fitting(sizes: list[tuple[int, int]], most: int) -> tuple[list[int], list[int]]:
    """Ids taken in order as long as their sizes add up to at most ``most``, and ids left out. sizes: (id, size)."""
    taken, out, total = [], [], 0
    for id_, size in sizes:
        (taken if total + size <= most else out).append(id_)
        total += size if total + size <= most else 0
    return taken, out


def train(docs: DataFrame, labels: DataFrame) -> dict[str, np.ndarray] | None:
    """Model from the bounded sample; None without labels of both classes."""
    sample = (
        labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL")
        .filter(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0)
        .groupBy("doc_id")
        .agg(F.max("quality").alias("_quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(SAMPLE)
    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = as_bytes(batch.column(2))
            bags = []
            for part in slices(texts, SLICE):
                x, first = passages(texts[part])
                bags += [x[i:j].astype(np.float16).tobytes() for i, j in zip(first, first[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(bags, pa.binary())], ["id", "y", "bag"])

    encoded = stored(
        docs.select("doc_id", "text")
        .join(F.broadcast(sample), "doc_id")  # SAMPLE rows at most
        .select(F.col("doc_id").cast("long"), F.col("_quality").cast("int"), "text")
        .mapInArrow(tidy(encode), "id long, y int, bag binary")
    )
    size = F.sum(F.expr(f"octet_length(bag) div {2 * WIDTH}")).alias("n")
    sizes = encoded.groupBy("id").agg(size).orderBy(F.xxhash64("id"), "id").collect()  # SAMPLE rows at most
    _, out = fitting([(r["id"], r["n"]) for r in sizes], BAGS)
    rows = (encoded.filter(~F.col("id").isin(out)) if out else encoded).toArrow().sort_by("id")
    y = rows.column("y").to_numpy().astype(np.float32)
    if len(set(y)) < 2:
        return None
    bags = [np.frombuffer(b, np.float16).reshape(-1, WIDTH).astype(np.float32) for b in rows.column("bag").to_pylist()]
    return fit(bags, (y > 0).astype(np.float32))


def scored(docs: DataFrame, labels: DataFrame, name: str = "score") -> DataFrame:
    """``docs`` with a column ``name``, which must not be one of theirs."""
    model = train(docs, labels)
    names = docs.columns
    at = names.index("text")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = as_bytes(batch.column(at))
            scores = np.full(len(texts), 0.5)
            for part in slices(texts, SLICE) if model else ():
                scores[part] = np.round(attend(model, *passages(texts[part]))[0].astype(float), 5)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], [*names, name])

    return docs.mapInArrow(tidy(score), ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema), f"`{name}` double"]))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    return scored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), labels).select(
        "doc_id",
        (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def keep(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not rejected, all columns kept."""
    name = "score"
    while name in map(str.lower, docs.columns):
        name = f"_{name}"
    return scored(docs, labels, name).filter(F.col(name) >= THRESHOLD).drop(name)
