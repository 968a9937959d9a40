"""The prefix trie of conversations against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import zlib

import duckdb
import pytest

from orderloom.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, id string, depth int, parent long, ends string"
COLUMNS = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()


def brute(rows, every=100, most=6):
    conversations: dict = {}
    for conversation, turn, role, text in rows:
        if conversation is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:16]
            conversations.setdefault(conversation, []).append((turn is not None, turn or 0, role, digest, text))
    own = {c: [(t[2], t[4]) for t in sorted(turns)] for c, turns in conversations.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % most
        built[c] = tuple(own.get(c - int(math.fmod(c, every)), [])[:h] + turns[h:])
    nodes: dict = {}
    for c, path in built.items():
        for d in range(len(path) + 1):
            nodes.setdefault(path[:d], []).append(c)
    children: dict = {}
    for node in nodes:
        if node:
            children.setdefault(node[:-1], []).append(node)
    totals: dict = {}
    for node in sorted(nodes, key=len, reverse=True):
        below = [totals[k] for k in children.get(node, [])]
        saved = (len(nodes[node]) - 1) * len(node[-1][1]) if node else 0
        totals[node] = (sum(n for n, _ in below) if below else 1, saved + sum(s for _, s in below))
    out = []
    for node, members in nodes.items():
        ends = ",".join(str(c) for c in sorted(members) if len(built[c]) == len(node))
        parent = min(nodes[node[:-1]]) if node else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        out.append((min(members), len(node), parent, len(members), len(children.get(node, [])), *totals[node], digest))
    return sorted(out, key=str)


def found(spark, rows, **options):
    table = spark.createDataFrame([(*r, "x", 1, 2, "y") for r in rows], SCHEMA).repartition(5)
    result = prefix_trie.trie(table, **options)
    assert result.columns == COLUMNS
    return sorted((tuple(r) for r in result.collect()), key=str)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    out = [(c, t, rng.choice(["user", "assistant"]), rng.choice("ab")) for c in range(90, 260) for t in range(rng.randint(1, 7))]
    out += [(300 + k, t, "user", "same ünïcode 🙂") for k in range(30) for t in range(3)]  # a common conversation
    out += [(7, t, "user", "x" * (t % 50)) for t in range(400)]  # one very long conversation, its first turns absent elsewhere
    out += [(107, t, None, None) for t in range(3)] + [(100, 0, "user", "a")] * 3  # empty turns, repeated rows
    out += [(206, None, "user", "null comes first"), (206, None, None, "and ties"), (206, 0, "b", "a"), (206, 0, "a", "b")]
    out += [(-5, 1, "user", "a"), (None, 1, "user", "b"), (401, 0, "user", "z" * 200_000), (None, None, None, None)]
    return out


def test_trie_equals_brute_force(spark, rows):
    assert found(spark, rows) == brute(rows)


def test_a_long_conversation_is_dealt_over_tasks(spark):
    rows = [(c, t, "user", str(t // 7)) for c in (300, 301) for t in range(900)]
    turns = prefix_trie.turns_in_order(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(6))
    placed = {(r["conv_id"], r["place"]): r["after"] for r in turns.collect()}
    assert placed.keys() == {(c, p) for c in (300, 301) for p in range(1, 901)}
    assert all(placed[300, p] == placed[301, p] for p in range(1, 901)) and len({*placed.values()}) == 900
    assert found(spark, rows, most=1) == brute(rows, most=1)


def test_trie_of_nothing(spark):
    assert found(spark, [(None, 1, "user", "a")]) == []


def test_sql_equals_brute_force(rows):
    table = duckdb.connect()
    table.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    short = [r for r in rows if r[0] != 7]
    table.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", short)
    result = table.execute(prefix_trie.ORACLE_SQL)
    assert [c[0] for c in result.description] == COLUMNS
    assert sorted(result.fetchall(), key=str) == brute(short)
