"""Near duplicates against all pairs, with small and with large limits."""

import random
import re

import numpy as np
import pytest

from grantlens.llm import near
from grantlens.llm.components import connected

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    words = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def brute(rows):
    sets = {i: shingles(text) for i, text in rows if i is not None}
    top = {i: i for i in sets}

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    ids = sorted(sets)
    for k, i in enumerate(ids):
        for j in ids[k + 1 :]:
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((find(i), find(j)))
                top[b] = a
    return {i: (len(sets[i]), find(i), find(i) == i) for i in ids}


def corpus(seed):
    """Copies, families of edited copies around the threshold, a shared passage, short texts."""
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(4000)]
    text = lambda n: [draw.choice(vocabulary) for _ in range(n)]
    passage, texts = text(60), []
    for _ in range(60):
        texts.append(text(draw.randrange(30, 120)) + passage)
    for size in (3, 12, 90):
        base = text(100)
        for _ in range(size):
            edited = list(base)
            for _ in range(draw.randrange(0, 7)):
                edited[draw.randrange(len(edited))] = draw.choice(vocabulary)
            texts.append(edited)
    for base in (text(8), text(4), text(1)):
        texts += [base, base[:-1], base + text(1), [w.upper() for w in base]]
    texts += [texts[0]] * 25 + [[]]
    joined = [draw.choice([" ", "  ", "\n"]).join(words) for words in texts]
    draw.shuffle(joined)
    return list(enumerate(joined))


@pytest.mark.parametrize(
    "limits",
    [
        {},
        {"LEAF": 8, "DEPTH": 2, "BLOCK": 10},
        {"LEAF": 8, "DEPTH": 0, "BLOCK": 10, "MOST_BLOCKS": 2},
    ],
    ids=["as set", "branches and blocks", "blocks of nodes, leaf by leaf"],
)
def test_all_pairs(spark, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(near, name, value)
    rows = corpus(len(limits))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = near.near_duplicates(docs).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in found} == brute(rows)


def test_odd_rows(spark, odd_docs, no_docs):
    found = near.near_duplicates(odd_docs).collect()
    assert len(found) == odd_docs.count()
    got = {(r.doc_id, r.n_shingles): (r.component_id, r.kept) for r in found}
    assert got[1, 9] == (1, True) and got[2, 9] == (1, False)
    assert got[3, 0] == (3, True) and got[4, 0] == (4, True) and got[5, 0] == (5, True)
    assert got[6, 1] == (6, True) and got[7, 1] == (6, False)
    assert got[None, 1] == (None, True)
    assert got[8, 2] == (8, True)
    assert near.near_duplicates(no_docs).count() == 0
    kept = near.keep_first(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(r.doc_id or 0 for r in kept.select("doc_id").collect()) == [0, 1, 3, 4, 5, 6, 8, 9]


def test_whole_groups_whatever_the_batches():
    import pyarrow as pa

    keys = np.sort(np.random.default_rng(1).integers(0, 30, 200))
    for size in (1, 3, 7, 200):
        batches = [
            pa.RecordBatch.from_arrays([pa.array(keys[i : i + size])], ["k"]) for i in range(0, 200, size)
        ]
        groups = [table.column(0).to_pylist() for table in near._groups(iter(batches))]
        assert sum(groups, []) == keys.tolist()
        for one, other in zip(groups, groups[1:]):
            assert one[-1] != other[0]


def test_pairs_of_equal_keys():
    keys = np.array([1, 1, 1, 2, 3, 3])
    for chunk in (1, 2, 100):
        pairs = [p for left, right in near._pairs(keys, chunk) for p in zip(left.tolist(), right.tolist())]
        assert pairs == [(0, 1), (0, 2), (1, 2), (4, 5)]


def test_components_of_a_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(40)]
    star = [(100, 100 + i) for i in range(1, 60)] + [(130, 131), (7, 7), (None, 3)]
    links = spark.createDataFrame(path + star, "a long, b long")
    got = {r.id: r.component for r in connected(links, "test-links").collect()}
    assert got == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(60)}


def test_components_with_hot_ids(spark):
    """Stars far over the share that makes an id hot, beside drawn links far under it, against union-find."""
    rng = np.random.default_rng(5)
    drawn = [tuple(map(int, pair)) for pair in rng.integers(0, 2_500, (1_200, 2))]
    stars = [(hub, 10_000 + 5_000 * hub + i) for hub in (3, 9, 11) for i in range(1_500)]
    middle = [(90_000 + int(i), 95_000) for i in rng.permutation(4_000)]
    root = {}

    def find(i):
        while root.setdefault(i, i) != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    linked = [(a, b) for a, b in drawn + stars + middle if a != b]
    for a, b in linked:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    links = spark.createDataFrame(drawn + stars + middle, "a long, b long")
    got = {r.id: r.component for r in connected(links, "test-hot").collect()}
    assert got == {i: find(i) for pair in linked for i in pair}
    assert connected(links.limit(0), "test-none").count() == 0


def test_leaves_of_long_texts_are_split(spark, monkeypatch):
    """All pairs of a leaf meet once, and no part is much over a block of shingles on a side."""
    monkeypatch.setattr(near, "BLOCK_SHINGLES", 2_000)
    long, short = range(100), range(100, 103)
    sizes = spark.createDataFrame([(i, 100 if i < 100 else 1) for i in range(103)], "doc_id long, n_shingles long")
    leaves = spark.createDataFrame([(1, i) for i in long] + [(2, i) for i in short], "node long, doc_id long")
    sets = sizes.selectExpr("doc_id", "9 AS blocks", "0 AS block", "X'00' AS tokens", "X'00' AS shingles")
    parts = {}
    for r in near._leaf_parts(leaves, sets, sizes).collect():
        parts.setdefault(r.part, []).append((r.doc_id, r.side))
    met = [
        (min(i, j), max(i, j))
        for rows in parts.values()
        for k, (i, a) in enumerate(rows)
        for j, b in rows[:k]
        if a < 0 or a != b
    ]
    assert len(met) == len(set(met))
    assert set(met) == {(i, j) for ids in (long, short) for i in ids for j in ids if i < j}
    for rows in parts.values():
        assert all(sum(side == one for _, side in rows) <= 40 for one in (-1, 0, 1))


def test_split_leaves_agree_with_brute_force(spark, monkeypatch):
    for name, value in {"LEAF": 8, "DEPTH": 0, "BLOCK": 10, "MOST_BLOCKS": 2, "BLOCK_SHINGLES": 150}.items():
        monkeypatch.setattr(near, name, value)
    rows = corpus(3)
    found = near.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in found} == brute(rows)


def test_sets_too_many_to_send(spark, monkeypatch):
    """Beyond what is broadcast, digests meet their components by a salted join."""
    monkeypatch.setattr(near.lookup_join, "__defaults__", ("inner", 0, None))
    monkeypatch.setattr(near, "fits_broadcast", lambda df: False)
    rows = [*corpus(4), (None, "a text without an id"), (10_000, None), (10_001, " ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = near.near_duplicates(docs)
    assert "_salt" in found._jdf.queryExecution().optimizedPlan().toString()
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in found.collect()}
    assert got.pop(None) == (1, None, True)
    assert got == brute(rows)
