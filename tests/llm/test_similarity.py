"""Joins of similar rows against brute force."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pytest

from orderloom.llm import decontamination, embedding_join, links, ngram_join

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, n):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(FOLD))
    return {tuple(words[k : k + n]) for k in range(len(words) - n + 1)} if len(words) >= n else {tuple(words)} - {()}


def smallest(ids, linked):
    parent = {i: i for i in ids}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a, b in linked:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {i: find(i) for i in ids}


def brute_components(rows, percent, n):
    sets = {i: shingles(t, n) for i, t in rows}
    pairs = [
        (a, b)
        for a in sets
        for b in sets
        if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    return sets, smallest(sets, pairs)


@pytest.mark.parametrize(("percent", "n", "chunk"), [(90, 3, 1000), (80, 5, 1000), (80, 3, 4)])
def test_ngram_join_equals_brute_force(frame, corpus, percent, n, chunk):
    sets, expected = brute_components(corpus, percent, n)
    result = ngram_join.join(frame(corpus), percent, n, chunk).collect()
    assert len(result) == len(corpus)
    assert {r["doc_id"]: r["component_id"] for r in result} == expected
    assert all(r["n_shingles"] == len(sets[r["doc_id"]]) for r in result)


def test_ngram_join_of_no_documents_and_of_wordless_ones(frame):
    assert ngram_join.join(frame([]), 90, 3).count() == 0
    rows = {r["doc_id"]: r["component_id"] for r in ngram_join.join(frame([(3, None), (1, ""), (2, " ")]), 90, 3).collect()}
    assert rows == {1: 1, 2: 2, 3: 3}


def test_keep_first_keeps_columns_and_one_of_each_group(frame, corpus):
    docs = frame(corpus)
    kept = ngram_join.keep_first(docs)
    assert kept.columns == docs.columns
    _, expected = brute_components(corpus, 80, 5)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({*expected.values()})


def test_trie_finds_every_similar_set():
    rng = np.random.default_rng(3)
    similarity = ngram_join.Similarity(80)
    base = np.sort(rng.choice(10_000, 60, replace=False))
    sets = [np.unique(np.concatenate([rng.choice(base, 55, replace=False), rng.integers(0, 10_000, 3)])) for _ in range(40)]
    root = ngram_join.trie(sets)
    for probe in sets:
        expected = {k for k, s in enumerate(sets) if 5 * len(np.intersect1d(s, probe)) >= 4 * len(np.union1d(s, probe))}
        assert set(ngram_join.linked(probe, root, similarity, lambda _: False)) == expected


def test_near_keeps_every_similar_set_and_few_others():
    rng = np.random.default_rng(4)
    similarity = ngram_join.Similarity(80)
    sets = []
    for size in (1, 2, 5, 31, 33, 60, 250, 260, 700):
        base = np.unique(rng.integers(-(2**63), 2**63, size))
        sets += [np.sort(base[rng.random(len(base)) < share]) for share in (1, 0.95, 0.85, 0.8, 0.5)]
        sets += [np.unique(np.concatenate([base, rng.integers(-(2**63), 2**63, more)])) for more in (1, size // 9, size // 4, size)]
    sets = [s for s in sets if len(s)]
    rows = [(len(s), ngram_join.sketch(s)) for s in sets]
    kept = 0
    for x, found in zip(sets, ngram_join.near(rows, rows, similarity)):
        similar = {k for k, s in enumerate(sets) if 5 * len(np.intersect1d(s, x)) >= 4 * len(np.union1d(s, x))}
        assert similar <= set(found.tolist()) and len(set(found.tolist())) == len(found)
        kept += len(found)
    assert kept < len(sets) ** 2 / 5
    assert [len(f) for f in ngram_join.near(rows[:2], [], similarity)] == [0, 0]


def test_sets_of_a_large_block_go_only_where_they_may_be_similar(frame, tmp_path, monkeypatch):
    rng = np.random.default_rng(11)
    base = [f"w{k}" for k in range(200)]
    rows = []
    for i in range(48):  # alike enough to meet, too far apart to be linked
        words = list(base)
        for k in rng.choice(200, 6, replace=False):
            words[k] = f"x{i}y{k}"
        rows.append((i, " ".join(words)))
    rows += [(100 + i, rows[i][1] + " more") for i in (3, 20, 41)]
    calls, task = [], ngram_join._chunk_task

    def counting(similarity):
        folder = tmp_path / str(len(calls))
        folder.mkdir()
        calls.append(folder)
        run, place = task(similarity), str(folder)

        def counted(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            import uuid

            tables = list(tables)
            with open(f"{place}/{uuid.uuid4().hex}", "w") as out:
                out.write(str(sum(t.num_rows for t in tables)))
            yield from run(iter(tables))

        return counted

    monkeypatch.setattr(ngram_join, "_chunk_task", counting)
    found = {r["doc_id"]: r["component_id"] for r in ngram_join.join(frame(rows), 80, 5, 8).collect()}
    assert found == brute_components(rows, 80, 5)[1]
    assert found[103] == 3 and len(set(found.values())) == 48
    sent = sum(int(f.read_text()) for f in calls[-1].iterdir())
    assert sent <= len(rows)


def test_similar_sets_share_a_node():
    rng = np.random.default_rng(9)
    for percent in (80, 90):
        similarity = ngram_join.Similarity(percent)
        for size in (1, 2, 5, 9, 10, 11, 37, 150, 900):
            x = np.unique(rng.integers(0, 2**63, size, dtype=np.uint64))
            drop = len(x) * (100 - percent) // 100
            y = x[drop:]
            if 100 * len(y) >= percent * len(x) and len(y):
                assert np.intersect1d(similarity.node_keys(x), similarity.node_keys(y)).size
                for share in (0.1, 0.5, 0.95):
                    popular = rng.random(1 << 12) < share
                    assert np.intersect1d(similarity.node_keys(x, popular), similarity.node_keys(y, popular)).size


def test_components_of_chains_stars_and_loops(spark):
    edges = [(5, 4), (4, 3), (3, 2), (2, 9), (9, 8), (20, 21), (21, 20), (7, 7), (30, 31), (30, 32), (33, 30)]
    frame = spark.createDataFrame(edges, "a long, b long")
    found = {r["id"]: r["component"] for r in links.components(frame, task_links=2).collect()}
    assert found == {r["id"]: r["component"] for r in links.components(frame).collect()}
    assert found == {2: 2, 3: 2, 4: 2, 5: 2, 8: 2, 9: 2, 20: 20, 21: 20, 30: 30, 31: 30, 32: 30, 33: 30}
    assert links.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_contained_items_equal_brute_force(spark, frame, corpus):
    long = max((t or "" for _, t in corpus), key=len).split()
    items = [(1, " ".join(long[50:70])), (2, " ".join(long[5:9])), (3, None), (4, ""), (5, " ".join([*long[100:130], "zzz", *long[131:150]]))]
    items += [(6, " ".join(long[300:420])), (6, " ".join(long[300:420])), (7, "never seen words at all in any text here")]
    items += [(8, " ".join(long[40:43])), (9, long[7].upper()), (10, "never seen"), (11, " \t"), (12, "One two"), (13, " ".join(long[60:64]))]
    expected = set()
    for item, text in {i: t for i, t in items}.items():
        want = shingles(text, 5)
        n = min(5, len((text or "").split()))
        for doc, body in corpus:
            have = shingles(body, n) & want if n else set()
            if want and 100 * len(have) >= 80 * len(want):
                expected.add((doc, item, len(want), len(have)))
    docs = frame(corpus)
    known = spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, hits string")
    found = {tuple(r) for r in decontamination.contained_items(docs, known).collect()}
    assert found == expected and {i for _, i, _, _ in found} == {1, 2, 5, 6, 8, 9, 12, 13}
    clean = decontamination.decontaminate(docs, known)
    assert clean.columns == docs.columns
    assert {r["doc_id"] for r in clean.collect()} == {i for i, _ in corpus} - {d for d, *_ in expected}
    assert decontamination.contained_items(frame([]), known).count() == 0
    assert decontamination.contained_items(docs, known.limit(0)).count() == 0


@pytest.mark.parametrize("chunk", [6000, 7])
def test_embedding_join_equals_brute_force(spark, chunk):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(8, 64))
    vectors = [(centres[k % 8] + rng.normal(0, 0.25, 64)).astype(np.float32).tolist() for k in range(60)]
    vectors += [vectors[0]] * 4 + [(2 * np.array(vectors[1], np.float32)).tolist()]
    odd = [None, [], [0.0] * 64, [float("nan")] * 64, [None] * 64, [float("inf")] + [1.0] * 63, [1.0, 2.0], [2.0, 4.0]]
    rows = [(100 + 3 * k, v, 0, "x") for k, v in enumerate([*odd, *vectors])]
    result = embedding_join.join(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, links string"), chunk=chunk)

    def fine(v):
        return v and None not in v and np.isfinite(v).all() and any(v)

    linked = []
    for a, x, *_ in rows:
        for b, y, *_ in rows:
            if a != b and fine(x) and fine(y) and len(x) == len(y):
                x_, y_ = np.array(x, float), np.array(y, float)
                if x_ @ y_ / (np.linalg.norm(x_) * np.linalg.norm(y_)) >= 0.9:
                    linked.append((a, b))
    expected = smallest([r[0] for r in rows], linked)
    found = {r["vec_id"]: r for r in result.collect()}
    assert {k: r["component_id"] for k, r in found.items()} == expected
    assert {k: r["n_links"] for k, r in found.items()} == {k: sum(a == k for a, _ in linked) for k in expected}
    assert all(r["kept"] == (r["component_id"] == k) for k, r in found.items())
    assert embedding_join.join(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_embedding_join_compares_doubles(spark):
    rows = [(1, [1e300, 2e300, 0.0]), (2, [1e300, 2e300, 0.0]), (3, [1e-300, 2e-300, 0.0]), (4, [1.0, 2.0, 1e-9]), (5, [-1.0, 0.0, 0.0]), (6, [0.0, 0.0, 5e-324])]
    result = embedding_join.join(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in result} == {1: (3, 1), 2: (3, 1), 3: (3, 1), 4: (3, 1), 5: (0, 5), 6: (0, 6)}
    rng = np.random.default_rng(1)
    centre = rng.normal(size=8)
    rows = [(k, (centre + rng.normal(0, 0.2, 8)).tolist() if k % 3 else np.float32(centre + rng.normal(0, 0.2, 8)).tolist()) for k in range(60)]
    x = np.array([v for _, v in rows])
    x /= np.linalg.norm(x, axis=1)[:, None]
    found = embedding_join.join(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), chunk=9).collect()
    assert {r["vec_id"]: r["n_links"] for r in found} == dict(enumerate(((x @ x.T >= 0.9).sum(1) - 1).tolist()))


def test_embedding_join_sends_no_vector_to_meet_another(spark, monkeypatch):
    plans, stored = [], embedding_join.stored

    def seen(df):
        if df.columns == ["id", "links", "a", "b"]:
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return stored(df)

    monkeypatch.setattr(embedding_join, "stored", seen)
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(4, 16))
    vectors = [(centres[k % 4] + rng.normal(0, 0.3, 16)).astype(np.float32).tolist() for k in range(40)]
    vectors += [vectors[10], vectors[4][:8], vectors[5][:8], (np.array(vectors[4][:8]) * 3.0).tolist()]
    frame = spark.createDataFrame([(k // 2 if k < 4 else k, v) for k, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    found = {tuple(r) for r in embedding_join.join(frame, chunk=7, held=1500).collect()}
    assert len(plans) > 2 and not any("Exchange" in plan for plan in plans)  # rounds of bounded groups
    assert found == {tuple(r) for r in embedding_join.join(frame).collect()}
    linked = [
        sum(len(x) == len(y) and np.dot(x, y) >= 0.9 * np.linalg.norm(x) * np.linalg.norm(y) for y in vectors) - 1
        for x in vectors
    ]
    assert {(r[0], r[1]) for r in found if r[0] > 3} == {(k, n) for k, n in enumerate(linked) if k > 3} and sum(linked)
