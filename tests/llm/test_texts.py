"""Packing, sharding, repeats, language model: against brute force and exact round trips."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from orderloom.llm import hidden_markov, packing, sharding, suffix_dedup

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def test_packing_is_a_round_trip_without_gaps(frame, corpus):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    ids = {i: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0] for i, t in corpus}
    rows = packing.pack(frame(corpus)).collect()
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append(r)
    assert pieces.keys() == ids.keys()
    for doc, parts in pieces.items():
        at = 0
        for r in sorted(parts, key=lambda r: r["start"]):
            part = np.array(ids[doc][at : at + r["length"]], "<u4")
            assert (r["start"], r["ids_crc32"], r["doc_tokens"]) == (at, zlib.crc32(part.tobytes()), len(ids[doc]))
            at += r["length"]
        assert at == len(ids[doc])
    padding = 0
    for parts in sequences.values():
        at = 0
        for r in sorted(parts, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= packing.SIZE
        padding += packing.SIZE - at if at & (at - 1) else 0
    assert padding <= 0.01 * sum(map(len, ids.values()))
    assert packing.pack(frame([])).count() == 0


def test_tokenizer_has_the_ids_of_the_published_one(corpus):
    import public_tokenizers
    from tokenizers import Tokenizer

    published = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    published.encode_special_tokens = True
    own = packing.tokenizer()
    for text in ["<|endoftext|> it's  3.14\n\n  x", "   é😀ß", *(t for _, t in corpus if t)]:
        assert own(text) == published.encode(text, add_special_tokens=False).ids


def test_ids_are_those_of_the_unaltered_tokenizer(frame, corpus):
    import public_tokenizers
    from tokenizers import Tokenizer

    published = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    blank = " " * 1_000_000
    texts = ["a <|endoftext|> b", "<|endoftext|><|endoftext|>", "<|endoftext|", blank + "a", "x" + "\t\n" * 2000 + "é", " " * 999 + "a", "b" * 3000]
    to_ids = packing.encoder()
    for text in [*texts, *(t for _, t in corpus if t)]:
        assert to_ids(text) == published.encode(text, add_special_tokens=False).ids
    assert 50256 in to_ids(texts[0])
    pieces = defaultdict(list)
    for r in packing.pack(frame(list(enumerate(texts)))).collect():
        pieces[r["doc_id"]].append(r)
    assert len(pieces) == len(texts)
    for doc, parts in pieces.items():
        ids = np.array([*published.encode(texts[doc], add_special_tokens=False).ids, 0], "<u4")
        assert sum(r["length"] for r in parts) == len(ids)
        for r in parts:
            part = ids[r["start"] : r["start"] + r["length"]]
            assert (r["ids_crc32"], r["doc_tokens"]) == (zlib.crc32(part.tobytes()), len(ids))


def test_column_generation_reaches_the_bound_and_the_demand_holds():
    rng = random.Random(2)
    histogram = Counter(rng.randint(1, 99) for _ in range(5000))
    places, sequences = packing.places(dict(histogram), 100, 3)
    placed, filled = Counter(), Counter()
    for length, low, high, copies, base, at in places:
        assert low == placed[length]
        placed[length] += high - low
        for nth in range(high - low):
            filled[base + nth // copies] += length
    assert all(placed[k] <= n for k, n in histogram.items())
    assert set(filled) == set(range(sequences)) and all(97 <= n <= 100 for n in filled.values())
    lengths = np.array(sorted(histogram))
    demand = np.array([histogram[k] for k in lengths], float)
    patterns, uses = packing.solve(lengths, demand, 100)
    assert np.allclose(uses @ patterns, demand) and (patterns @ lengths <= 100).all()
    assert uses.sum() <= 1.02 * (lengths @ demand / 100)


def brute_capacity(sizes, shards):
    capacity = max(max(sizes), -(-sum(sizes) // shards))
    while True:
        used, fill = 1, 0
        for s in sizes:
            used, fill = (used, fill + s) if fill + s <= capacity else (used + 1, s)
        if used <= shards:
            return capacity
        capacity += 1


@pytest.mark.parametrize("shards", [3, 16])
def test_shards_are_minimax_and_gapless(frame, corpus, shards, monkeypatch):
    monkeypatch.setattr(sharding, "FIRST_BITS", 2)  # several rounds of refinement
    rows = sharding.shard(frame(corpus), shards).collect()
    texts = dict(corpus)
    groups, slots, bytes_ = {}, defaultdict(list), Counter()
    for r in rows:
        text = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(text) + 1, zlib.crc32(text), "bytes", None)
        assert groups.setdefault(text, r["shard"]) == r["shard"]
        slots[r["shard"]].append(r["slot"])
        bytes_[r["shard"]] += r["size"]
    assert len(rows) == len(corpus)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    order = Counter()
    for text in (texts[r["doc_id"]] or "" for r in rows):
        order[hashlib.md5(text.encode()).hexdigest()[:15]] += len(text.encode()) + 1
    assert max(bytes_.values()) == brute_capacity([order[k] for k in sorted(order)], shards)
    assert sharding.shard(frame([]), shards).count() == 0


def brute_removed(rows):
    seen, out = set(), {}
    for doc, text in sorted(rows):
        data = (text or "").encode()
        windows = [data[k : k + 50] for k in range(len(data) - 49)]
        spans = []
        for k, w in enumerate(windows):
            if w in seen:
                if spans and k <= spans[-1][1]:
                    spans[-1][1] = k + 50
                else:
                    spans.append([k, k + 50])
        seen.update(windows)
        kept, at = b"", 0
        for a, b in spans:
            kept, at = kept + data[at:a], b
        kept += data[at:]
        out[doc] = (len(data), sum(b - a for a, b in spans), len(spans), hashlib.sha256(kept).hexdigest())
    return out


def test_suffix_dedup_equals_brute_force(frame, corpus):
    found = {r["doc_id"]: tuple(r)[1:] for r in suffix_dedup.dedup(frame(corpus)).collect()}
    assert found == brute_removed(corpus)
    assert suffix_dedup.dedup(frame([])).count() == 0


@pytest.mark.parametrize("windows", [40, 300_000])
def test_hot_anchors_are_split_exactly(frame, corpus, windows, monkeypatch):
    rng = random.Random(8)
    say = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    phrase, tails = "the phrase that many documents carry", [say(60) for _ in range(9)]
    rows = [(2000 + k, say(80) + phrase + rng.choice(tails)[: rng.randint(5, 60)] + say(80)) for k in range(150)]
    rows += [(3000 + k, (say(70) + phrase + tails[k % 9]) * 2) for k in range(20)] + corpus
    monkeypatch.setattr(suffix_dedup, "HOT", 6)
    monkeypatch.setattr(suffix_dedup, "SEEN", 2)
    monkeypatch.setattr(suffix_dedup, "WINDOWS", windows)
    monkeypatch.setattr(suffix_dedup, "BUCKET_PIECES", 50)
    largest, hot = [], suffix_dedup.hot_anchors

    def spied(runs, most):
        largest.append(hot(runs, most))
        return largest[-1]

    monkeypatch.setattr(suffix_dedup, "hot_anchors", spied)
    found = {r["doc_id"]: tuple(r)[1:] for r in suffix_dedup.dedup(frame(rows)).collect()}
    assert len(largest[0][0]) and largest[0][1] > 150
    assert found == brute_removed(rows)


def test_loser_tree_merges_with_exact_common_prefixes():
    rng = random.Random(4)
    texts = ["".join(rng.choice("ab") for _ in range(rng.randint(0, 12))).encode() for _ in range(400)]
    runs = [suffix_dedup.suffix_run([(t, (k, 0, b"")) for k, t in enumerate(texts) if k % 7 == r]) for r in range(7)] + [[]]
    merged = list(suffix_dedup.merged(runs))
    assert [m[1] for m in merged] == sorted(texts)
    assert [m[0] for m in merged[1:]] == [suffix_dedup._lcp(a[1], b[1]) for a, b in zip(merged, merged[1:])]
    assert list(suffix_dedup.merged([])) == []


def test_front_coding_is_a_round_trip():
    keys = np.unique(np.random.default_rng(1).integers(0, 2**40, 5000, dtype=np.uint64))
    assert (suffix_dedup.front_decoded(*suffix_dedup.front_coded(keys)) == keys).all()
    assert len(suffix_dedup.front_decoded(*suffix_dedup.front_coded(keys[:0]))) == 0


def test_base_scores_and_counts_equal_brute_force(frame, corpus):
    rows = hidden_markov.score(frame(corpus), states=3, iterations=2).collect()
    tokens = {i: [*re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(FOLD)), None] for i, t in corpus}
    counts = Counter(w for i, t in tokens.items() if zlib.crc32(str(i).encode()) % 7 != 2 for w in t)
    n, v = sum(counts.values()), len(counts)
    assert len(rows) == len(corpus)
    for r in rows:
        t = tokens[r["doc_id"]]
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in t)
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(t), sum(counts[w] > 0 for w in t), n)
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 7 == 2)
        assert math.isclose(r["base_score"], base, rel_tol=1e-9) and -math.inf < r["score"] < 0
    assert hidden_markov.score(frame([])).count() == 0


def test_forward_and_baum_welch_equal_sums_over_all_paths():
    from itertools import product

    rng = np.random.default_rng(0)
    norm = lambda x: x / x.sum(-1, keepdims=True)
    start, move, emit = norm(rng.random(2)), norm(rng.random((2, 2))), norm(rng.random((2, 3))).T
    model = tuple(x.astype(np.float32) for x in (start, move, emit))
    texts = [np.array(t, np.uint16) for t in ([0], [1, 2, 0], [2, 2, 1, 0, 1])]
    emits, moves, likely = np.zeros((3, 2)), np.zeros((2, 2)), []
    for text in texts:
        paths = list(product(range(2), repeat=len(text)))
        p = [start[q[0]] * np.prod([move[a, b] for a, b in zip(q, q[1:])]) * np.prod([emit[s, k] for s, k in zip(text, q)]) for q in paths]
        likely.append(np.log10(sum(p)))
        for q, w in zip(paths, np.array(p) / sum(p)):
            for s, k in zip(text, q):
                emits[s, k] += w
            for a, b in zip(q, q[1:]):
                moves[a, b] += w
    assert np.allclose(hidden_markov.log_likelihoods(texts, model), likely, atol=1e-5)
    counted = hidden_markov.expected_counts(texts, np.ones(3, bool), model, np.full(2, 0.5, np.float32))
    assert np.allclose(counted[1], moves, atol=1e-4) and np.allclose(counted[2], emits, atol=1e-4)
