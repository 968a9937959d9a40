"""Removal of repeated 50-byte strings by a distributed, common-prefix-aware merge sort of sampled suffixes.

Every 50-byte window has one anchor, its k-gram of least hash (the leftmost of equals), so equal
windows have their anchors at the same place. Neighbouring windows with one anchor form a
piece: the text from the first window's start to the last one's end. All equal windows lie in pieces
whose anchors are equal, so only suffixes that begin at anchors have to be brought together.

1. Fingerprints of anchors and pieces are exchanged as front-coded sorted runs, as in
   communication-efficient string sorting, where fingerprints find what need not be sent in full. A piece
   that equals one of a smaller document is removed as a whole; an anchor that occurs once settles its windows.
2. What is left are anchors with unequal pieces: the edges of repeated passages. Their suffixes
   from the anchor on are sorted in each task, exchanged front-coded, and merged by a loser tree that
   keeps the common prefix of each run's head with the last winner, and compares characters only
   beyond it. In the sorted order, common prefixes give how far two suffixes agree to the right;
   the bytes before the anchor give how far they agree to the left.
   The windows of an anchor with very many unequal pieces are compared by their bytes instead: each task
   sends the smallest document of each window only, and buckets of windows decide among those.
3. The covered stretches are merged for each document and cut out.

Equal (anchor, piece) pairs are reduced to their smallest document in each task before they are sent, so
a passage that very many documents share is one entry per task. Documents under 50 bytes, and null or
empty texts, keep all bytes. Rows with one id are one document: nothing is removed between them. Other columns are
not read. Fingerprints are 80 bits wide (anchor and piece).
"""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm._shared import BROADCAST_ROWS, as_bytes, mix, powers, prefix_hashes, slices, stored

LENGTH, GRAM, WIDTH = 50, 24, 5
#: Text bytes worked on at once.
SLICE = 1 << 18
#: Anchors of a run, and about how many bytes of text one bucket of the exchanges serves.
RUN, BUCKET_BYTES = 400_000, 4_000_000
#: Unequal pieces from which on an anchor is hot: its pieces and windows are spread over buckets. Runs report anchors
#: with SEEN pieces or more, so an anchor that is not hot has at most HOT + SEEN * runs of them.
HOT, SEEN = 20_000, 8
#: Windows sent at once, and how many pieces' windows one bucket of windows serves.
WINDOWS, BUCKET_PIECES = 300_000, 10_000


def pieces(texts: list[bytes], length: int = LENGTH, gram: int = GRAM):
    """(text, first window's start, last window's start, anchor, anchor hash, piece hash) of all pieces, positions within
    the joined texts, and where the texts begin there."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.array([len(t) for t in texts], np.int64)
    begins = np.concatenate(([0], np.cumsum(sizes)))
    n, span = len(data), length - gram + 1
    if n < length:
        none = np.zeros(0, np.int64)
        return none, none, none, none, none.astype(np.uint64), none.astype(np.uint64), begins
    sums, inverse = prefix_hashes(data), powers(n)[1]
    hashes = mix((sums[gram:] - sums[:-gram]) * inverse[: n - gram + 1])
    least, at, width = hashes, np.arange(len(hashes), dtype=np.int32), 1
    while width < span:  # minimum over twice the width, at last over all of it; the left one of equals
        step = min(width, span - width)
        take = least[step:] < least[:-step]
        at = np.where(take, at[step:], at[:-step])
        least = np.minimum(least[step:], least[:-step])
        width += step
    ends = np.repeat(begins[1:], sizes)[: len(at)]
    starts = np.flatnonzero(ends - np.arange(len(at)) >= length)
    if not len(starts):
        none = np.zeros(0, np.int64)
        return none, none, none, none, none.astype(np.uint64), none.astype(np.uint64), begins
    anchor = at[starts].astype(np.int64)
    new = np.flatnonzero(np.concatenate(([True], (np.diff(anchor) != 0) | (np.diff(starts) != 1))))
    first, last = starts[new], starts[np.append(new[1:], len(starts)) - 1]
    anchor = anchor[new]
    size = (last + length - first).astype(np.uint64)
    whole = mix((sums[last + length] - sums[first]) * inverse[first] + size)
    return np.searchsorted(begins, first, "right") - 1, first, last, anchor, hashes[anchor], whole, begins


def front_coded(keys: np.ndarray) -> tuple[bytes, bytes]:
    """Sorted 40-bit keys as common prefix lengths with the one before, and what differs."""
    rows = keys.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - WIDTH :]
    same = np.concatenate((np.zeros((1, WIDTH), bool), rows[1:] == rows[:-1])) if len(rows) else np.zeros((0, WIDTH), bool)
    shared = np.logical_and.accumulate(same, axis=1).sum(1).astype(np.uint8)
    return shared.tobytes(), rows[np.arange(WIDTH) >= shared[:, None]].tobytes()


def front_decoded(shared: bytes, rest: bytes) -> np.ndarray:
    shared = np.frombuffer(shared, np.uint8)
    given = np.arange(WIDTH) >= shared[:, None]
    rows = np.zeros((len(shared), WIDTH), np.uint8)
    rows[given] = np.frombuffer(rest, np.uint8)
    source = np.maximum.accumulate(np.where(given, np.arange(len(shared))[:, None], 0), axis=0)
    wide = np.zeros((len(shared), 8), np.uint8)
    wide[:, 8 - WIDTH :] = np.take_along_axis(rows, source, 0)
    return wide.view(">u8").ravel().astype(np.uint64)


def _key(anchor: np.ndarray, piece: np.ndarray) -> np.ndarray:
    return mix(anchor * np.uint64(0x9E3779B97F4A7C15) ^ mix(piece))


def _place(anchor: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of a 40-bit anchor fingerprint: ranges, so a sorted run splits into slices."""
    return (anchor >> np.uint64(16)) * np.uint64(buckets) >> np.uint64(24)


def _owners(anchor, piece, doc):
    """Sorted distinct (anchor, piece) with their smallest document, and all others as repeats."""
    order = np.lexsort((doc, piece, anchor))
    anchor, piece, doc = anchor[order], piece[order], doc[order]
    first = np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (piece[1:] != piece[:-1])))[: len(anchor)]
    owner = doc[first][np.cumsum(first) - 1] if len(doc) else doc
    repeat = doc != owner
    return (anchor[first], piece[first], doc[first]), (anchor[repeat], piece[repeat], doc[repeat])


def _told(doc: np.ndarray, keys: np.ndarray, kind: int, parts: int) -> list[tuple[int, int, bytes, bytes]]:
    """Keys told to documents, packed by slices of documents: (slice, kind, documents, keys)."""
    place = (mix(doc.astype(np.uint64)) % np.uint64(parts)).astype(np.int64)
    order = np.argsort(place, kind="stable")
    doc, keys, place = doc[order], keys[order], place[order]
    edges = np.append(np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))[: len(doc)], len(doc))
    return [(int(place[i]), kind, doc[i:j].tobytes(), keys[i:j].tobytes()) for i, j in zip(edges, edges[1:])]


#: Kind of the rows that report how many unequal pieces anchors have in a run.
COUNTS = 2
RUNS = "bucket int, shared binary, rest binary, pieces binary, doc_at binary, docs binary, slice int, kind int, owners binary, keys binary"
_RUN_FIELDS = [("bucket", pa.int32())] + [(c, pa.binary()) for c in ("shared", "rest", "pieces", "doc_at", "docs")]
_TOLD_FIELDS = [("slice", pa.int32()), ("kind", pa.int32()), ("owners", pa.binary()), ("keys", pa.binary())]


def _rows(rows: list[tuple], told: list[tuple]) -> pa.RecordBatch:
    n, m = len(rows), len(told)
    columns = [pa.array([*(r[k] for r in rows), *[None] * m], t) for k, (_, t) in enumerate(_RUN_FIELDS)]
    columns += [pa.array([*[None] * n, *(r[k] for r in told)], t) for k, (_, t) in enumerate(_TOLD_FIELDS)]
    return pa.RecordBatch.from_arrays(columns, [c for c, _ in _RUN_FIELDS + _TOLD_FIELDS])


def fingerprint_runs(docs: DataFrame, buckets: int) -> DataFrame:
    """Front-coded sorted runs of (anchor, piece, document), and repeats found within a task."""

    def flush(found) -> pa.RecordBatch:
        (anchor, piece, doc), (a, p, d) = _owners(*(np.concatenate(x) for x in zip(*found)))
        edges = np.searchsorted(_place(anchor, buckets), np.arange(buckets + 1))
        rows = []
        for k in np.flatnonzero(np.diff(edges)):
            part = slice(edges[k], edges[k + 1])
            rows.append(_run_row(int(k), anchor[part], piece[part], doc[part]))
        starts = np.flatnonzero(np.concatenate(([True], anchor[1:] != anchor[:-1])))
        number = np.diff(np.append(starts, len(anchor)))
        many = number >= seen
        reported = [(None, COUNTS, anchor[starts][many].tobytes(), number[many].astype(np.int64).tobytes())] if many.any() else []
        return _rows(rows, _told(d, _key(a, p), 0, buckets) + reported)

    seen = SEEN

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, size = [], 0
        for batch in batches:
            texts, ids = as_bytes(batch.column(1)), batch.column(0).to_numpy(zero_copy_only=False)
            for part in slices(texts, SLICE):
                text, _, _, _, anchor, piece, _ = pieces(texts[part])
                found.append((anchor >> np.uint64(24), piece >> np.uint64(24), ids[part][text]))
                size += len(text)
                if size > RUN:
                    yield flush(found)
                    found, size = [], 0
        if found:
            yield flush(found)

    return docs.mapInArrow(run, RUNS)


def hot_anchors(runs: DataFrame, most: int) -> tuple[np.ndarray, int]:
    """Sorted anchors with more than ``most`` unequal pieces, as summed over runs, and the number of their pieces."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            anchor = np.frombuffer(b"".join(batch.column(0).to_pylist()), np.int64)
            number = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.int64)
            anchor, at = np.unique(anchor, return_inverse=True)
            total = np.bincount(at, number, len(anchor)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(total)], ["anchor", "n"])

    counts = runs.filter(F.col("kind") == COUNTS).select("owners", "keys").mapInArrow(summed, "anchor long, n long")
    # At most one row for each ``most`` pieces of the input.
    rows = counts.groupBy("anchor").agg(F.sum("n").alias("n")).filter(F.col("n") > most).orderBy("anchor").collect()
    return np.array([r["anchor"] for r in rows], np.uint64), sum(r["n"] for r in rows)


def _run_arrays(r: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchors, pieces and documents of a run's row."""
    n = len(r["shared"])
    wide = np.zeros((n, 8), np.uint8)
    wide[:, 8 - WIDTH :] = np.frombuffer(r["pieces"], np.uint8).reshape(n, WIDTH)
    at = np.frombuffer(r["doc_at"], np.uint16 if len(r["doc_at"]) == 2 * n else np.uint32)
    return front_decoded(r["shared"], r["rest"]), wide.view(">u8").ravel().astype(np.uint64), np.frombuffer(r["docs"], np.int64)[at]


def _run_row(bucket: int, anchor: np.ndarray, piece: np.ndarray, doc: np.ndarray) -> tuple:
    ids, at = np.unique(doc, return_inverse=True)
    wide = piece.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - WIDTH :]
    kind = np.uint16 if len(ids) < 65536 else np.uint32
    return (bucket, *front_coded(anchor), wide.tobytes(), at.astype(kind).tobytes(), ids.tobytes())


def spread(runs: DataFrame, buckets: int, hot: np.ndarray) -> DataFrame:
    """The runs, with the pieces of hot anchors dealt by anchor and piece, no longer by anchor."""
    columns = ["bucket", *(c for c, _ in _RUN_FIELDS[1:])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                anchor, piece, doc = _run_arrays(r)
                moved = np.isin(anchor, hot)
                if not moved.any():
                    yield _rows([tuple(r[c] for c in columns)], []).select(columns)
                    continue
                place = np.where(moved, (_key(anchor, piece) % np.uint64(buckets)).astype(np.int64), r["bucket"])
                rows = [_run_row(int(b), *(x[place == b] for x in (anchor, piece, doc))) for b in np.unique(place)]
                yield _rows(rows, []).select(columns)

    return runs.select(columns).mapInArrow(run, RUNS.split(", slice")[0])


def replies(runs: DataFrame, buckets: int, hot: np.ndarray) -> DataFrame:
    """slice, kind (0: the piece is a repeat, 1: its anchor has other pieces too), documents and keys of pieces."""

    def run(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = []
        for t in tables:
            for r in t.select(["shared", "rest", "pieces", "doc_at", "docs"]).to_pylist():
                found.append(_run_arrays(r))
        (anchor, piece, doc), (a, p, d) = _owners(*(np.concatenate(x) for x in zip(*found)))
        new = np.concatenate(([True], anchor[1:] != anchor[:-1]))
        group, starts = np.cumsum(new) - 1, np.flatnonzero(new)
        # Unequal pieces of one anchor matter only between documents.
        several = (np.minimum.reduceat(doc, starts) != np.maximum.reduceat(doc, starts))[group]
        several |= np.isin(anchor, hot)  # other pieces are in other buckets
        told = _told(d, _key(a, p), 0, buckets)
        told += _told(doc[several], _key(anchor[several], piece[several]), 1, buckets)
        yield _rows([], told).select([c for c, _ in _TOLD_FIELDS])

    runs = runs.filter("bucket IS NOT NULL")
    runs = spread(runs, buckets, hot) if len(hot) else runs
    return runs.groupBy("bucket").applyInArrow(run, "slice int, kind int, owners binary, keys binary")


def by_document(told: DataFrame) -> DataFrame:
    """doc_id, covered, open (lists of binary keys), one row for each document that is told anything."""

    def run(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        doc, key, kind = [], [], []
        for t in tables:
            for r in t.select(["kind", "owners", "keys"]).to_pylist():
                doc.append(np.frombuffer(r["owners"], np.int64))
                key.append(np.frombuffer(r["keys"], np.uint64))
                kind.append(np.full(len(doc[-1]), r["kind"], np.int8))
        doc, key, kind = (np.concatenate(x) for x in (doc, key, kind))
        order = np.lexsort((kind, doc))
        doc, key, kind = doc[order], key[order], kind[order]
        first = np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1])))
        edges = np.append(first, len(doc))
        middle = edges[:-1] + np.add.reduceat(kind == 0, first)
        columns = [
            pa.array([[key[i:j].tobytes()] for i, j in pairs], pa.list_(pa.binary()))
            for pairs in (zip(edges[:-1], middle), zip(middle, edges[1:]))
        ]
        yield pa.RecordBatch.from_arrays([pa.array(doc[first]), *columns], ["doc_id", "covered", "open"])

    return told.groupBy("slice").applyInArrow(run, "doc_id long, covered array<binary>, open array<binary>")


# --- suffix runs ------------------------------------------------------------------------------


def _lcp(x: bytes, y: bytes, known: int = 0) -> int:
    n = min(len(x), len(y))
    while known + 8 <= n and x[known : known + 8] == y[known : known + 8]:
        known += 8
    while known < n and x[known] == y[known]:
        known += 1
    return known


class Head:
    """The first suffix left of a sorted run, and its common prefix with the last suffix taken out of the tree."""

    __slots__ = ("run", "at", "text", "lcp")

    def __init__(self, run, at: int, text: bytes, lcp: int):
        self.run, self.at, self.text, self.lcp = run, at, text, lcp


def _beats(x: Head | None, y: Head | None) -> bool:
    """Whether x comes before y; the loser's common prefix becomes that with the winner.

    Both are known against the last winner, which is not larger than either: the one that shares more with
    it is smaller, and the other shares with it just what it shared before. Only equals are compared, from there on.
    """
    if x is None or y is None:
        return y is None
    if x.lcp != y.lcp:
        return x.lcp > y.lcp
    shared = _lcp(x.text, y.text, x.lcp)
    first = x.text[shared : shared + 1] <= y.text[shared : shared + 1]
    (y if first else x).lcp = shared
    return first


def merged(runs: list[list[tuple[int, bytes, tuple]]]) -> Iterator[tuple[int, bytes, tuple]]:
    """Merges sorted runs of (common prefix with the one before, suffix, value) into one, by a loser tree."""
    leaves = 1
    while leaves < len(runs):
        leaves *= 2
    heads = [Head(r, 0, r[0][1], 0) if r else None for r in runs] + [None] * (leaves - len(runs))
    losers: list[int] = [0] * leaves
    winners = list(range(leaves))
    level = leaves
    while level > 1:  # first round: pairs play, losers stay
        level //= 2
        for k in range(level):
            a, b = winners[2 * k], winners[2 * k + 1]
            if not _beats(heads[a], heads[b]):
                a, b = b, a
            losers[level + k], winners[k] = b, a
    top = winners[0]
    while (head := heads[top]) is not None:
        yield head.lcp, head.text, head.run[head.at][2]
        at = head.at + 1
        if at < len(head.run):
            lcp, text, _ = head.run[at]
            heads[top] = Head(head.run, at, text, lcp)
        else:
            heads[top] = None
        node = (leaves + top) // 2
        while node:
            other = losers[node]
            if not _beats(heads[top], heads[other]):
                losers[node], top = top, other
            node //= 2


def suffix_run(rows: list[tuple[bytes, tuple]]) -> list[tuple[int, bytes, tuple]]:
    rows.sort(key=lambda r: r[0])
    before, out = b"", []
    for text, value in rows:
        out.append((_lcp(before, text), text, value))
        before = text
    return out


def common(group: list[tuple[int, bytes, tuple]], length: int = LENGTH) -> Iterator[tuple[int, int, int]]:
    """(document, start, end) that suffixes of one anchor share with ones of a smaller document.

    group: in sorted order, value (document, anchor position, bytes before the anchor). A window that takes o bytes
    from the left can only be shared if o bytes before and length - o bytes from the anchor on agree; of each window the
    smallest document is kept. Windows that no neighbour reaches to the right are not looked at.
    """
    reach = [max(g[0] if k else 0, group[k + 1][0] if k + 1 < len(group) else 0) for k, g in enumerate(group)]
    if len(group) <= 6:
        for i, (_, x, (doc, at, before)) in enumerate(group):
            if reach[i] + len(before) < length:
                continue
            for j, (_, y, (other, _, left)) in enumerate(group):
                if other < doc and i != j:
                    right = min((g[0] for g in group[min(i, j) + 1 : max(i, j) + 1]), default=0)
                    back = _lcp(before[::-1], left[::-1])
                    if back + right >= length:
                        yield doc, at - back, at + right
        return
    least: dict[tuple[bytes, bytes], int] = {}
    for final in (False, True):
        for k, (_, text, (doc, at, before)) in enumerate(group):
            for o in range(max(0, length - min(reach[k], len(text))), min(len(before), length) + 1):
                window = before[len(before) - o :], text[: length - o]
                if not final:
                    least[window] = min(least.get(window, doc), doc)
                elif least[window] < doc:
                    yield doc, at - o, at - o + length


def _packed(spans: dict[int, list[tuple[int, int]]]) -> pa.RecordBatch:
    rows = [(d, np.array(s, np.int64).tobytes()) for d, s in spans.items()]
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())], ["doc_id", "spans"]
    )


SENT = (
    "doc_id long, spans binary, bucket int, shared binary, texts array<binary>, docs binary, places binary, lefts array<binary>, "
    "part int, windows binary"
)


def _least(windows: dict[bytes, tuple[int, list[int]]], spans: dict[int, list[tuple[int, int]]], window: bytes, doc: int, at: list[int]) -> None:
    """Keeps the smallest document of a window with its places; any other loses the window there."""
    kept = windows.get(window)
    if kept is None:
        windows[window] = doc, at
    elif kept[0] == doc:
        kept[1].extend(at)
    else:
        lost, places = (doc, at) if kept[0] < doc else kept
        if doc < kept[0]:
            windows[window] = doc, at
        spans[lost] += [(a, a + LENGTH) for a in places]


def marked(told: DataFrame, buckets: int, hot: np.ndarray, parts: int) -> DataFrame:
    """Removed stretches of documents, sorted runs of the suffixes of their undecided pieces, and, for those of hot anchors,
    the smallest document of each window by part.

    told: doc_id, text, covered and open (lists of binary keys)."""
    names = ["doc_id", "spans", "bucket", "shared", "texts", "docs", "places", "lefts", "part", "windows"]
    kinds = [pa.int64(), pa.binary(), pa.int32(), pa.binary(), pa.list_(pa.binary()), pa.binary(), pa.binary(), pa.list_(pa.binary()), pa.int32(), pa.binary()]

    def sent(undecided: dict[int, list]) -> pa.RecordBatch:
        rows = []
        for bucket, found in undecided.items():
            run = suffix_run(found)
            shared = [min(r[0], 255) for r in run]
            rows.append(
                (
                    None,
                    None,
                    bucket,
                    bytes(shared),
                    [r[1][s:] for r, s in zip(run, shared)],
                    np.array([r[2][0] for r in run], np.int64).tobytes(),
                    np.array([r[2][1] for r in run], np.int64).tobytes(),
                    [r[2][2] for r in run],
                    None,
                    None,
                )
            )
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kinds[k]) for k in range(10)], names)

    def sent_windows(windows: dict, lost: dict) -> pa.RecordBatch:
        dealt = defaultdict(list)
        for window, (doc, at) in windows.items():
            dealt[zlib.crc32(window) % parts] += [(window, doc, a) for a in at]
        rows = [(d, np.array(x, np.int64).tobytes(), *[None] * 8) for d, x in lost.items()]
        for part, x in dealt.items():
            docs, places = (np.array([w[k] for w in x], np.int64).tobytes() for k in (1, 2))
            rows.append((*[None] * 5, docs, places, None, part, b"".join(w[0] for w in x)))
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kinds[k]) for k in range(10)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        undecided, size = defaultdict(list), 0
        windows, lost, looked = {}, defaultdict(list), 0
        for batch in batches:
            texts, ids = as_bytes(batch.column(1)), batch.column(0).to_pylist()
            keys = [[np.frombuffer(b"".join(x or []), np.uint64) for x in batch.column(c).to_pylist()] for c in (2, 3)]
            done = []
            for part in slices(texts, SLICE):
                text, first, last, anchor, a, p, begins = pieces(texts[part])
                key = _key(a >> np.uint64(24), p >> np.uint64(24))
                place = _place(a >> np.uint64(24), buckets)
                spread_out = np.isin(a >> np.uint64(24), hot)
                edges = np.searchsorted(text, np.arange(len(begins)))
                for k, (i, j) in enumerate(zip(edges, edges[1:])):
                    at = part.start + k
                    covered = np.isin(key[i:j], keys[0][at])
                    spans = np.stack([first[i:j][covered], last[i:j][covered] + LENGTH], 1) - begins[k]
                    done.append((ids[at], spans.astype(np.int64).tobytes()) if len(spans) else None)
                    for n in i + np.flatnonzero(np.isin(key[i:j], keys[1][at]) & ~covered):
                        b, own = begins[k], texts[at]
                        f, q, e = first[n] - b, anchor[n] - b, last[n] - b + LENGTH
                        if spread_out[n]:
                            for w in range(int(f), int(e) - LENGTH + 1):
                                _least(windows, lost, own[w : w + LENGTH], ids[at], [w])
                            looked += int(e - f) - LENGTH + 1
                            if looked > most:
                                yield sent_windows(windows, lost)
                                windows, lost, looked = {}, defaultdict(list), 0
                            continue
                        undecided[int(place[n])].append((own[q:e], (ids[at], int(q), own[f:q])))
                        size += 1
            done = [d for d in done if d]
            none = [pa.nulls(len(done), k) for k in kinds[2:]]
            yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], kinds[0]), pa.array([d[1] for d in done], kinds[1]), *none], names)
            if size > 200_000:
                yield sent(undecided)
                undecided, size = defaultdict(list), 0
        yield sent(undecided)
        yield sent_windows(windows, lost)

    most = WINDOWS
    return told.mapInArrow(run, SENT)


def shared_windows(sent: DataFrame) -> DataFrame:
    """doc_id, spans: windows of hot anchors that a smaller document of another task has too."""

    def run(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least, spans = {}, defaultdict(list)
        for t in tables:
            for r in t.select(["windows", "docs", "places"]).to_pylist():
                places = zip(np.frombuffer(r["docs"], np.int64).tolist(), np.frombuffer(r["places"], np.int64).tolist())
                for k, (doc, at) in enumerate(places):
                    _least(least, spans, r["windows"][k * LENGTH : (k + 1) * LENGTH], doc, [at])
        yield _packed(spans)

    return sent.filter("part IS NOT NULL").select("part", "windows", "docs", "places").groupBy("part").applyInArrow(run, "doc_id long, spans binary")


def shared_edges(sent: DataFrame) -> DataFrame:
    """doc_id, spans: stretches that undecided pieces share with smaller documents."""

    def run(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = []
        for t in tables:
            for r in t.select(["shared", "texts", "docs", "places", "lefts"]).to_pylist():
                before, decoded = b"", []
                values = zip(np.frombuffer(r["docs"], np.int64).tolist(), np.frombuffer(r["places"], np.int64).tolist(), r["lefts"])
                for shared, rest, value in zip(r["shared"], r["texts"], values):
                    before = before[:shared] + rest
                    decoded.append((shared, before, value))
                runs.append(decoded)
        spans, group = defaultdict(list), []

        def close():
            for doc, start, end in common(group) if len(group) > 1 else ():
                spans[doc].append((start, end))

        for item in merged(runs):
            if group and item[0] < GRAM:
                close()
                group = []
            group.append(item)
        close()
        yield _packed(spans)

    return sent.filter("bucket IS NOT NULL").select("bucket", "shared", "texts", "docs", "places", "lefts").groupBy("bucket").applyInArrow(
        run, "doc_id long, spans binary"
    )


def _union(spans: np.ndarray) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in spans[np.argsort(spans[:, 0], kind="stable")].tolist():
        if out and start <= out[-1][1]:
            out[-1] = out[-1][0], max(out[-1][1], end)
        else:
            out.append((start, end))
    return out


def cut(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256. docs: doc_id, text, spans (list of binary)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, spans in zip(as_bytes(batch.column(1)), batch.column(2).to_pylist()):
                removed = _union(np.frombuffer(b"".join(spans or []), np.int64).reshape(-1, 2))
                digest, at = hashlib.sha256(), 0
                for start, end in [*removed, (len(text), len(text))]:
                    digest.update(text[at:start])
                    at = end
                rows.append((len(text), sum(e - s for s, e in removed), len(removed), digest.hexdigest()))
            columns = [pa.array([r[k] for r in rows], pa.string() if k == 3 else pa.int64()) for k in range(4)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return docs.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def dedup(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every document."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(4, -(-size // BUCKET_BYTES))
    runs = stored(fingerprint_runs(texts, buckets))
    hot, hot_pieces = hot_anchors(runs, HOT)
    told = runs.filter("slice IS NOT NULL").select("slice", "kind", "owners", "keys").union(replies(runs, buckets, hot))
    told = stored(by_document(told))
    ids = told.select("doc_id")
    asked = texts.join(F.broadcast(ids), "doc_id", "left_semi") if told.count() <= BROADCAST_ROWS else texts
    sent = stored(marked(asked.join(told, "doc_id").select("doc_id", "text", "covered", "open"), buckets, hot, max(1, -(-hot_pieces // BUCKET_PIECES))))
    spans = sent.filter("spans IS NOT NULL").select("doc_id", "spans").union(shared_edges(sent))
    spans = spans.union(shared_windows(sent)) if len(hot) else spans
    spans = stored(spans.groupBy("doc_id").agg(F.collect_list("spans").alias("spans")))
    if spans.count() <= BROADCAST_ROWS:  # documents that lose nothing don't move
        touched = F.broadcast(spans.select("doc_id"))
        whole = texts.join(touched, "doc_id", "left_anti").withColumn("spans", F.lit(None).cast("array<binary>"))
        return cut(texts.join(touched, "doc_id", "left_semi").join(spans, "doc_id").select("doc_id", "text", "spans")).union(cut(whole))
    return cut(texts.join(spans, "doc_id", "left").select("doc_id", "text", "spans"))
