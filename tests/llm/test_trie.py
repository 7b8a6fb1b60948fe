"""Tries of conversations against plain loops; double arrays against a dictionary of beginnings."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from grantlens.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string"


def _checksum(role, text):
    return hashlib.md5(f"{len(role.encode())}:{role}:{text}".encode()).digest()


def _own(rows):
    found = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            found.setdefault(conv, []).append((turn, role or "", text or ""))
    return {
        conv: [r[1:] for r in sorted(turns, key=lambda r: (r[0] is not None, r[0] or 0, _checksum(*r[1:])))]
        for conv, turns in found.items()
    }


def _rebuilt(rows):
    own, found = _own(rows), {}
    for conv, turns in own.items():
        n = zlib.crc32(str(conv).encode()) % 6
        block = conv - (abs(conv) % 100) * (1 if conv >= 0 else -1)
        found[conv] = own.get(block, [])[:n] + turns[n:]
    return found


def _plain(paths):
    members = {}
    for conv, path in paths.items():
        for d in range(len(path) + 1):
            members.setdefault(tuple(path[:d]), []).append(conv)
    out = []
    for node, convs in members.items():
        below = [n for n in members if n[: len(node)] == node]
        children = [n for n in below if len(n) == len(node) + 1]
        leaves = [n for n in below if not any(m[:-1] == n for m in members if m)]
        ends = sorted(c for c in convs if len(paths[c]) == len(node))
        out.append(
            (
                min(convs),
                len(node),
                min(members[node[:-1]]) if node else None,
                len(convs),
                len(children),
                len(leaves),
                sum((len(members[n]) - 1) * len(n[-1][1]) for n in below if n),
                hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
            )
        )
    return sorted(out, key=repr)


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def _random_rows(seed, n):
    draw, rows = random.Random(seed), []
    shared = [(draw.choice("ua"), "s" * i) for i in range(9)]
    for conv in range(n):
        id = draw.choice([conv, conv, conv * 37, -conv])
        path = shared[: draw.choice([0, 0, 2, 9])] + [
            (draw.choice(["user", "assistant", None]), draw.choice(["x", "yy", "", None, "é" * 5]))
            for _ in range(draw.randrange(1, 5))
        ]
        rows += [(id, draw.choice([turn, turn, turn, None]), role, text) for turn, (role, text) in enumerate(path)]
    return rows + [(None, 0, "user", "no id")]


@pytest.mark.parametrize("most", [1, 12, 60, trie.SHARD_TURNS])
def test_tries_of_shards_of_any_size(spark, most):
    rows = _random_rows(most, 130)
    turns = spark.createDataFrame([(*r, "key", 3) for r in rows], SCHEMA + ", above string, depth int").repartition(7)
    assert _rows(trie.prefix_trie(trie.conversations(turns, borrow=True), most)) == _plain(_rebuilt(rows))


def test_without_borrowed_turns(spark):
    rows = _random_rows(5, 60)
    got = trie.prefix_trie(trie.conversations(spark.createDataFrame(rows, SCHEMA)), 30)
    assert _rows(got) == _plain(_own(rows))


def test_many_copies_and_a_long_conversation(spark, monkeypatch):
    monkeypatch.setattr(trie, "ENDS_BLOCK", 16)
    rows = [(conv, turn, "user", f"t{turn}") for conv in range(-40, 160) for turn in range(3)]
    rows += [(1000, turn, "user", f"t{turn}") for turn in range(90)] + [(1001, turn, "user", f"t{turn}") for turn in range(80)]
    for most in (100, 10_000):
        assert _rows(trie.prefix_trie(trie.conversations(spark.createDataFrame(rows, SCHEMA)), most)) == _plain(_own(rows))


def test_turnless_and_no_conversations(spark):
    # crc32("0") % 6 = 3: the only turns of 0 give way to the head of 0, which are they.
    ids = [c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 > 1][:3]
    turns = spark.createDataFrame([(c, 0, "user", "gone") for c in ids], SCHEMA)
    [root] = trie.prefix_trie(trie.conversations(turns, borrow=True)).collect()
    ends = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    assert tuple(root) == (min(ids), 0, None, 3, 0, 1, 0, ends)
    assert trie.prefix_trie(trie.conversations(turns.limit(0), borrow=True)).count() == 0


def test_a_query_of_the_small_tables(spark, small_tables):
    from grantlens.llm.queries import QUERIES

    turns = spark.read.parquet(f"{small_tables}/conversations.parquet").select("conv_id", "turn", "role", "text")
    got = _rows(QUERIES["op11_prefix_trie"](spark, small_tables))
    assert got == _plain(_rebuilt(list(map(tuple, turns.collect()))))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.integers(0, 6), max_size=6), min_size=1, max_size=40))
def test_double_arrays_hold_their_paths(given_paths):
    lengths = np.array([len(path) for path in given_paths], np.int64)
    made = trie.DoubleArray(np.array([c for path in given_paths for c in path], np.int64), lengths)
    slots = {(): 0}
    for depth, (of, at, _) in enumerate(made.walk()):
        for path, slot in zip(of.tolist(), at.tolist()):
            beginning = tuple(given_paths[path][: depth + 1])
            assert slots.setdefault(beginning, slot) == slot and made.check[slot] == slots[beginning[:-1]]
    assert len(set(slots.values())) == len(slots) == len({tuple(p[:d]) for p in given_paths for d in range(len(p) + 1)})
    for beginning, slot in slots.items():
        children = made.child(np.full(7, slot), np.arange(7))
        assert {c for c in range(7) if children[c] > 0} == {p[-1] for p in slots if p and p[:-1] == beginning}
