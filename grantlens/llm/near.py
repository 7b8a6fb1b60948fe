"""Near duplicates by a chosen-path set similarity join.

A document's set is its distinct five-word shingles.  Documents with
``100 * intersection >= 75 * union`` are linked; a component is what links reach.

1. **Sets.**  One pass hashes the shingles and takes ``COORDINATES`` minwise tokens per set.
   Equal sets (by a 128-bit digest) are one set from here on: copies travel as one row.
2. **Trees.**  In each of ``TREES`` independent trees the root sends a set to the node of one minwise
   token.  A node with more than ``LEAF`` sets branches: it chooses two coordinates by a
   hash of its path and sends each set on to the two nodes of its tokens there.
   Sets alike share a token with a probability of at least 0.75, so their common paths rarely
   die out, while sets that share a passage part soon.  Nodes with one set are
   dropped.  Recall: a pair at 0.75 meets in a tree with probability 0.66 or more, in one of
   16 trees but for 3e-8.
3. **Leaves** are compared exhaustively on the tokens.  Nodes that are still large after ``DEPTH`` levels
   are compared in pairs of blocks, so none is left out.  A leaf reports only to whom each
   set is connected there, not its pairs.
4. **Clusters** of what the leaves connected are then settled on full sets: every pair whose tokens
   agree enough is confirmed, unless its two sets are connected already.  Large clusters are
   settled in pairs of blocks; a cluster of more than ``MOST_BLOCKS`` blocks, leaf by
   leaf, and a leaf of many shingles again in pairs of blocks.
   Again no pairs come out, only links that connect.
5. **Components** of the confirmed links.

The token threshold lies five standard deviations under 0.75 (a pair at 0.75 falls
under it once in a million), so tokens only save work; links are decided on full sets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from grantlens.llm.components import connected
from grantlens.llm.select import without
from grantlens.llm.workers import tidied
from grantlens.operators.joins import fits_broadcast, lookup_join
from grantlens.session import staged

WORDS = 5
PERCENT = 75
TREES = 16
COORDINATES = 256
AGREEING = 158
LEAF = 4096
DEPTH = 4
# Sets of a block, and words of its shingles; blocks of a cluster that are compared in pairs.
BLOCK = 256
BLOCK_SHINGLES = 2_000_000
MOST_BLOCKS = 64
SEED = 20_240_501

# ---- sets -----------------------------------------------------------------------


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


# A number drawn for every byte at each of the first places of a word.
_DRAWN = _mixed(np.arange(1, 64 * 256 + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def word_hashes(words: list[bytes]) -> np.ndarray:
    """Hashes of words: sums of numbers drawn for each byte at its place."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    begin = np.cumsum(lengths) - lengths
    letters = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
    letters += (np.arange(len(letters)) - np.repeat(begin, lengths)) * 256
    far = np.flatnonzero(letters >= len(_DRAWN))
    drawn = _DRAWN[np.minimum(letters, len(_DRAWN) - 1)]
    if len(far):
        drawn[far] = _mixed((letters[far].astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
    return _mixed(np.add.reduceat(drawn, begin) + lengths.astype(np.uint64))


def shingle_set(text: bytes, words: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles; all its words as one if there are fewer.

    Lower-casing and splitting bytes touches ASCII only.
    """
    found = text.lower().split()
    if not found:
        return np.empty(0, np.uint64)
    hashes = word_hashes(found)
    width = min(words, len(hashes))
    shingles = hashes[: len(hashes) - width + 1].copy()
    for i in range(1, width):
        shingles *= np.uint64(0x9E3779B97F4A7C15)
        shingles += hashes[i : len(hashes) - width + 1 + i]
    # A short text must not meet a shingle of a longer one with the same words in it.
    return np.unique(_mixed(shingles + np.uint64(width)))


def minwise(shingles: np.ndarray, factors: np.ndarray, block: int = 4096) -> np.ndarray:
    """Smallest value of each hash function over a set that is not empty."""
    least = np.full(len(factors), np.iinfo(np.uint64).max)
    for start in range(0, len(shingles), block):
        hashed = shingles[start : start + block, None] * factors
        hashed ^= hashed >> np.uint64(32)
        np.minimum(least, hashed.min(axis=0), out=least)
    return least


def _factors() -> np.ndarray:
    draws = np.random.default_rng(SEED).integers(0, 1 << 63, COORDINATES, dtype=np.uint64)
    return draws * np.uint64(2) + np.uint64(1)


def _tokens(least: np.ndarray) -> bytes:
    # The low byte of a minimum tells nothing of its size, so it is even.
    return _mixed(least).astype(np.uint8).tobytes()


@tidied
def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, text) -> doc_id, n_shingles, digest, roots, tokens."""
    factors = _factors()
    for batch in batches:
        sizes, digests, roots, tokens = [], [], [], []
        for cell in batch.column(1):
            shingles = shingle_set(cell.as_py() or b"")
            sizes.append(len(shingles))
            if len(shingles):
                least = minwise(shingles, factors)
                digests.append(hashlib.blake2b(shingles.tobytes(), digest_size=16).digest())
                roots.append(least[:TREES].tobytes())
                tokens.append(_tokens(least))
            else:
                digests.append(None)
                roots.append(None)
                tokens.append(None)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array(sizes, pa.int64()),
                pa.array(digests, pa.binary()),
                pa.array(roots, pa.binary()),
                pa.array(tokens, pa.binary()),
            ],
            ["doc_id", "n_shingles", "digest", "roots", "tokens"],
        )


# ---- trees ------------------------------------------------------------------------


def _with_others(nodes: DataFrame) -> DataFrame:
    """(node, doc_id) -> (node, doc_id, n): nodes that hold two sets or more, with their size."""
    sizes = nodes.groupBy("node").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return nodes.join(sizes, "node").select("node", "doc_id", "n")


def _branches() -> Column:
    """The two nodes a set goes on to."""
    node = F.col("node")
    first = F.pmod(F.xxhash64(node, F.lit(1)), F.lit(COORDINATES))
    step = F.pmod(F.xxhash64(node, F.lit(2)), F.lit(COORDINATES - 1)) + 1
    second = F.pmod(first + step, F.lit(COORDINATES))
    return F.array(
        *[
            F.xxhash64(node, at, F.substring(F.col("tokens"), at.cast("int") + 1, F.lit(1)))
            for at in (first, second)
        ]
    )


def leaf_rows(reps: DataFrame) -> DataFrame:
    """(node, doc_id): every set in each leaf that it shares with others.

    ``reps`` has doc_id, roots and tokens.
    """
    tokens = reps.select("doc_id", "tokens")
    root = F.transform(
        F.sequence(F.lit(0), F.lit(TREES - 1)),
        lambda tree: F.xxhash64(tree, F.substring(F.col("roots"), tree * 8 + 1, F.lit(8))),
    )
    level = staged(_with_others(reps.select("doc_id", F.explode(root).alias("node"))), "nodes")
    leaves = [level.where(F.col("n") <= LEAF).select("node", "doc_id")]
    for _ in range(DEPTH):
        large = level.where(F.col("n") > LEAF)
        if large.isEmpty():
            return _union(leaves)
        children = large.join(tokens, "doc_id").select("doc_id", F.explode(_branches()).alias("node"))
        level = staged(_with_others(children), "nodes")
        leaves.append(level.where(F.col("n") <= LEAF).select("node", "doc_id"))
    # What is still large is compared in pairs of blocks: every two sets meet in one of them.
    blocks = F.ceil(F.col("n") / (LEAF // 2)).cast("int")
    own = F.pmod(F.xxhash64("doc_id"), blocks).cast("int")
    paired = F.transform(
        F.sequence(F.lit(0), blocks - 1),
        lambda other: F.xxhash64(F.col("node"), F.least(own, other), F.greatest(own, other)),
    )
    large = level.where(F.col("n") > LEAF).select(F.explode(paired).alias("node"), "doc_id")
    return _union([*leaves, large])


def _union(frames: list[DataFrame]) -> DataFrame:
    first, *others = frames
    for other in others:
        first = first.unionByName(other)
    return first


# ---- comparing in tasks -----------------------------------------------------------------


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Whole groups of rows with equal first column, from batches in its order."""
    kept: list[pa.RecordBatch] = []
    for batch in batches:
        keys = batch.column(0).to_numpy(zero_copy_only=False)
        cut = int(np.searchsorted(keys, keys[-1])) if len(keys) else 0
        if cut == 0 and kept and len(keys) and kept[-1].column(0)[-1].as_py() != keys[0]:
            yield pa.Table.from_batches(kept)
            kept = []
        if cut:
            yield pa.Table.from_batches([*kept, batch.slice(0, cut)])
            kept = []
        if len(keys):
            kept.append(batch.slice(cut))
    if kept:
        yield pa.Table.from_batches(kept)


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, width)


def _pairs(keys: np.ndarray, chunk: int = 1 << 16) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Indices of all pairs of rows with equal keys, in chunks; keys are in order."""
    n = len(keys)
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    ends = np.repeat(np.r_[starts[1:], n], np.diff(np.r_[starts, n]))
    partners = ends - np.arange(n) - 1
    done = np.r_[0, np.cumsum(partners)]
    low = 0
    while low < n:
        high = max(low + 1, int(np.searchsorted(done, done[low] + chunk, "right")) - 1)
        left = np.repeat(np.arange(low, high), partners[low:high])
        offset = np.arange(len(left)) - (done[left] - done[low])
        yield left, left + 1 + offset
        low = high


def _agreeing(tokens: np.ndarray, left: np.ndarray, right: np.ndarray):
    """The pairs whose tokens agree enough; a quarter of the tokens sorts out most others."""
    quarter = COORDINATES // 4
    # Seven standard deviations under 0.75.
    near = (tokens[left, :quarter] == tokens[right, :quarter]).sum(1) >= 24
    left, right = left[near], right[near]
    same = (tokens[left] == tokens[right]).sum(1)
    near = same >= AGREEING
    return left[near], right[near], same[near]


def _smallest_reached(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Smallest index that each of ``n`` indices reaches over the pairs."""
    label = np.arange(n)
    while True:
        least = np.minimum(label[left], label[right])
        before = label.copy()
        np.minimum.at(label, left, least)
        np.minimum.at(label, right, least)
        label = label[label]
        if np.array_equal(before, label):
            return label


@tidied
def _connect_leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, doc_id, n_shingles, tokens) by node -> (a, b) that connect what is alike in a leaf."""
    for table in _groups(batches):
        keys = table.column(0).to_numpy()
        ids, sizes = table.column(1).to_numpy(), table.column(2).to_numpy()
        tokens = _matrix(table.column(3), COORDINATES)
        found_left, found_right = [], []
        for left, right in _pairs(keys):
            fits = 100 * np.minimum(sizes[left], sizes[right]) >= PERCENT * np.maximum(
                sizes[left], sizes[right]
            )
            left, right, _ = _agreeing(tokens, left[fits], right[fits])
            if len(left):
                # Of a chunk only what connects is kept.
                reached = _smallest_reached(len(keys), left, right)
                moved = np.flatnonzero(reached != np.arange(len(keys)))
                found_left.append(reached[moved])
                found_right.append(moved)
        if not found_left:
            continue
        reached = _smallest_reached(len(keys), np.concatenate(found_left), np.concatenate(found_right))
        moved = np.flatnonzero(reached != np.arange(len(keys)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids[reached[moved]]), pa.array(ids[moved])], ["a", "b"]
        )


@tidied
def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replace the text, the last column, by its tokens and its set."""
    factors = _factors()
    for batch in batches:
        sets = [shingle_set(cell.as_py() or b"") for cell in batch.column(batch.num_columns - 1)]
        tokens = [_tokens(minwise(one, factors)) if len(one) else None for one in sets]
        yield pa.RecordBatch.from_arrays(
            [
                *batch.columns[:-1],
                pa.array(tokens, pa.binary()),
                pa.array([one.tobytes() for one in sets], pa.binary()),
            ],
            [*batch.schema.names[:-1], "tokens", "shingles"],
        )


def alike(one: np.ndarray, other: np.ndarray) -> bool:
    """Whether two sorted sets are linked."""
    if len(one) > len(other):
        one, other = other, one
    at = np.searchsorted(other, one)
    at[at == len(other)] = 0
    both = int((other[at] == one).sum())
    return 100 * both >= PERCENT * (len(one) + len(other) - both)


@tidied
def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(part, side, doc_id, tokens, shingles) by part -> (a, b), confirmed links that connect.

    Sides other than -1 meet only the other side of their part.
    """
    for table in _groups(batches):
        keys, sides = table.column(0).to_numpy(), table.column(1).to_numpy()
        ids, shingles = table.column(2).to_numpy(), table.column(4)
        tokens = _matrix(table.column(3), COORDINATES)
        sizes = np.array([len(cell.as_buffer()) for cell in shingles]) // 8
        root = list(range(len(keys)))

        def top(i):
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        links = []
        for left, right in _pairs(keys):
            fits = 100 * np.minimum(sizes[left], sizes[right]) >= PERCENT * np.maximum(
                sizes[left], sizes[right]
            )
            fits &= (sides[left] < 0) | (sides[left] != sides[right])
            left, right, same = _agreeing(tokens, left[fits], right[fits])
            for k in np.argsort(-same, kind="stable").tolist():
                i, j = int(left[k]), int(right[k])
                if top(i) != top(j) and alike(
                    np.frombuffer(shingles[i].as_buffer(), np.uint64),
                    np.frombuffer(shingles[j].as_buffer(), np.uint64),
                ):
                    root[top(j)] = top(i)
                    links.append((ids[i], ids[j]))
        if links:
            a, b = zip(*links)
            yield pa.RecordBatch.from_arrays(
                [pa.array(a, table.schema.types[2]), pa.array(b, table.schema.types[2])], ["a", "b"]
            )


# ---- the join ----------------------------------------------------------------------------


def _in_pairs(sets: DataFrame, group: str) -> DataFrame:
    """(part, side, doc_id, tokens, shingles): a part for every pair of a group's ``blocks``, own ones included."""
    block, other = F.col("block"), F.col("other")
    part = F.struct(
        F.xxhash64(group, F.least(block, other), F.greatest(block, other)).alias("part"),
        F.when(block == other, F.lit(-1)).when(block < other, 0).otherwise(1).alias("side"),
    )
    return (
        sets.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(part.alias("at"), "doc_id", "tokens", "shingles")
        .select("at.part", "at.side", "doc_id", "tokens", "shingles")
    )


def _leaf_parts(leaves: DataFrame, sets: DataFrame, sizes: DataFrame) -> DataFrame:
    """(part, side, doc_id, tokens, shingles): the leaves of ``sets`` in pairs of blocks.

    A block has about ``BLOCK_SHINGLES`` shingles, so that a leaf of long texts is in no task as a whole.
    """
    inside = leaves.join(sets.select("doc_id"), "doc_id").join(sizes, "doc_id")
    counted = inside.groupBy("node").agg(
        F.greatest(F.lit(1), F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES)).cast("int").alias("blocks")
    )
    # Other bits than those that dealt the blocks of large nodes.
    block = F.pmod(F.xxhash64("doc_id", F.lit("leaf")), F.col("blocks")).cast("int")
    placed = leaves.join(counted, "node").withColumn("block", block)
    return _in_pairs(placed.join(sets.select("doc_id", "tokens", "shingles"), "doc_id"), "node")


def _confirmed_links(docs: DataFrame, clusters: DataFrame, leaves: DataFrame, sizes: DataFrame):
    """Links (a, b) on full sets that connect what is linked inside the clusters."""
    counted = (
        clusters.join(sizes, "doc_id")
        .groupBy("cluster")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("shingles"))
        .select(
            "cluster",
            F.greatest(F.ceil(F.col("n") / BLOCK), F.ceil(F.col("shingles") / BLOCK_SHINGLES))
            .cast("int")
            .alias("blocks"),
        )
    )
    placed = staged(
        clusters.join(counted, "cluster").select(
            "doc_id",
            "cluster",
            "blocks",
            F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int").alias("block"),
        ),
        "clusters",
    )
    # Ids meet the texts; where all of them fit they go to the texts, which then stay in place.
    ids = F.broadcast(placed) if fits_broadcast(placed) else placed
    texts = docs.join(ids, "doc_id").select("doc_id", "cluster", "blocks", "block", "text")
    schema = texts.drop("text").schema.add("tokens", "binary").add("shingles", "binary")
    sets = staged(texts.mapInArrow(_sets, schema), "sets")
    paired = _in_pairs(sets.where(F.col("blocks") <= MOST_BLOCKS), "cluster")
    by_leaf = _leaf_parts(leaves, sets.where(F.col("blocks") > MOST_BLOCKS), sizes)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return (
        paired.unionByName(by_leaf)
        .repartition("part")
        .sortWithinPartitions("part")
        .mapInArrow(_confirm, f"a {kind}, b {kind}")
    )


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.

    ``component_id`` is the smallest id reachable over links, the row's own included; a row
    is kept if that is its own.  NULL and empty texts and texts of white space have no
    shingles and are linked with nothing.  A row with a NULL id is linked with nothing either: its component is
    NULL and it is kept.  Rows that repeat an id are one document, linked with what
    any of its texts is linked with.  An empty table gives an empty result; other columns are not read.
    """
    plain = docs.select(F.col(id).alias("doc_id"), F.col(text).cast("binary").alias("text"))
    kind = plain.schema["doc_id"].dataType.simpleString()
    signed = staged(
        plain.mapInArrow(
            _signatures,
            f"doc_id {kind}, n_shingles long, digest binary, roots binary, tokens binary",
        ),
        "signatures",
    )
    with_words = signed.where("n_shingles > 0 and doc_id is not null")
    first = staged(
        with_words.groupBy("digest").agg(F.min("doc_id").alias("rep")), "representatives"
    )
    reps = with_words.join(first.select(F.col("rep").alias("doc_id")).distinct(), "doc_id")
    leaves = leaf_rows(reps.select("doc_id", "roots", "tokens"))
    connections = (
        leaves.join(reps.select("doc_id", "n_shingles", "tokens"), "doc_id")
        .select("node", "doc_id", "n_shingles", "tokens")
        .repartition("node")
        .sortWithinPartitions("node")
        .mapInArrow(_connect_leaves, f"a {kind}, b {kind}")
    )
    clusters = connected(connections, "near-clusters").select(
        F.col("id").alias("doc_id"), F.col("component").alias("cluster")
    )
    links = _confirmed_links(plain, clusters, leaves, reps.select("doc_id", "n_shingles"))
    # Equal sets are linked through their first document.
    components = connected(links, "near-links")
    rep_of = first.join(components, first["rep"] == components["id"], "left").select(
        "digest", F.coalesce("component", "rep").alias("component")
    )
    # One digest can have very many documents, and all those without words have none.
    marked = lookup_join(
        signed.select("doc_id", "n_shingles", "digest"), staged(rep_of, "components-of-sets"), "digest", "left"
    )
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return marked.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
    )


def keep_first(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns; ids must be unique."""
    gone = near_duplicates(docs, id, text).where(~F.col("kept")).select(F.col("doc_id").alias(id))
    return without(docs, gone, id)
