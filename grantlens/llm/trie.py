"""Prefix trie of conversations, as double-array tries of shards of prefixes.

A conversation becomes the checksums of its turns; texts are read once and never shuffled.
Equal conversations fold into one path with a count.  Paths are dealt to shards by their
beginnings: a node with more turns below it than ``SHARD_TURNS``, of several paths, is an upper node, however deep
it lies, and each node just below the upper ones is the top of a shard.  So no beginning, however many
conversations share it, makes a large shard.  A task streams through its shards in order and packs
some of them at a time into one double-array trie: turns get dense numbers, a node is a slot of the arrays, and
its child by turn t is the slot ``base[node] + t``, if ``check`` names the node there.  Walking all
paths through the arrays at once gives every path's nodes, and their counts are added up level by level.

Upper nodes are put together from what the tops of the shards sum up, by aggregates over all shards.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from grantlens.operators.joins import lookup_join
from grantlens.session import staged

# Turns of the paths of one shard, unless it is a single path.
SHARD_TURNS = 50_000
# Conversations that end at one node are listed in blocks of this many ids.
ENDS_BLOCK = 4096
NOTHING = hashlib.sha256(b"").hexdigest()


# ---- conversations ---------------------------------------------------------------------


def conversations(turns: DataFrame, conv: str = "conv_id", borrow: bool = False) -> DataFrame:
    """(conv_id, path): checksum and length of the last text of every turn, in order.

    With ``borrow`` a conversation begins with the first crc32(id) % 6 turns of the one whose id is its own
    less the last two digits, in place of its own; where that has fewer they are all taken.
    """
    role, text = (F.coalesce(F.col(name), F.lit("")) for name in ("role", "text"))
    checksum = F.unhex(F.md5(F.concat_ws(":", F.octet_length(role).cast("string"), role, text)))
    said = F.struct(
        F.col("turn").isNotNull().alias("numbered"),
        F.col("turn").alias("turn"),
        checksum.alias("checksum"),
        F.length(text).cast("long").alias("chars"),
    )
    kind = turns.schema[conv].dataType.simpleString()
    own = (
        turns.where(F.col(conv).isNotNull())
        .groupBy(F.col(conv).alias("conv_id"))
        .agg(F.sort_array(F.collect_list(said)).alias("own"))
        .select("conv_id", F.transform("own", lambda turn: turn.dropFields("numbered", "turn")).alias("own"))
    )
    if not borrow:
        return own.withColumnRenamed("own", "path")
    own = staged(own, "conversations")
    heads = own.where("conv_id % 100 = 0").select(
        F.col("conv_id").alias("of"), F.slice("own", 1, 5).alias("head")
    )
    n = (F.crc32(F.col("conv_id").cast("string")) % 6).cast("int")
    # Ids of one head are at most 199, so no key is hot.
    return (
        own.withColumns({"of": (F.col("conv_id") - F.col("conv_id") % 100).cast(kind), "n": n})
        .join(heads, "of", "left")
        .select(
            "conv_id",
            F.concat(
                F.coalesce(F.slice("head", F.lit(1), F.col("n")), F.slice("own", 1, 0)),
                F.slice("own", F.col("n") + 1, F.greatest(F.size("own"), F.lit(1))),
            ).alias("path"),
        )
    )


def _keys(checksums: list[bytes]) -> list[bytes]:
    """Key of every beginning of a path, from the first turn on."""
    keys, last = [], b""
    for checksum in checksums:
        last = hashlib.md5(last + checksum).digest()
        keys.append(last)
    return keys


def _with_keys(convs: DataFrame) -> DataFrame:
    """(conv_id, end, keys, path): key of the whole path and of its beginnings."""
    kind = convs.schema["conv_id"].dataType.simpleString()
    path = "array<struct<checksum:binary,chars:bigint>>"

    def keyed(batches):
        for batch in batches:
            keys = [_keys([turn["checksum"] for turn in path]) for path in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([of[-1] if of else b"" for of in keys], pa.binary()),
                    pa.array(keys, pa.list_(pa.binary())),
                    batch.column(1),
                ],
                ["conv_id", "end", "keys", "path"],
            )

    return convs.select("conv_id", "path").mapInArrow(
        keyed, f"conv_id {kind}, end binary, keys array<binary>, path {path}"
    )


def _end_hashes(convs: DataFrame) -> DataFrame:
    """(end, ends_sha256): hash of the ids that end at a path, ascending; ids come in blocks, in order."""
    blocks = (
        convs.groupBy("end", F.floor(F.col("conv_id") / ENDS_BLOCK).alias("block"))
        .agg(F.array_join(F.sort_array(F.collect_list("conv_id")), ",").alias("ids"))
        .repartition("end")
        .sortWithinPartitions("end", "block")
    )

    def hashed(batches):
        end, digest = None, None
        for batch in batches:
            ends, hashes = [], []
            for of, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if of != end:
                    if digest:
                        ends.append(end)
                        hashes.append(digest.hexdigest())
                    end, digest = of, hashlib.sha256()
                else:
                    digest.update(b",")
                digest.update(ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array(ends, pa.binary()), pa.array(hashes, pa.string())], ["end", "ends_sha256"])
        if digest:
            yield pa.RecordBatch.from_arrays(
                [pa.array([end], pa.binary()), pa.array([digest.hexdigest()])], ["end", "ends_sha256"]
            )

    return blocks.mapInArrow(hashed, "end binary, ends_sha256 string")


def paths(convs: DataFrame) -> DataFrame:
    """One row per different path: end, n_convs, conv_id (the smallest), ends_sha256, keys, checksums, chars."""
    keyed = staged(_with_keys(convs), "keyed-conversations")
    first = keyed.groupBy("end").agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id"))
    shown = keyed.select(
        "conv_id",
        "keys",
        F.transform("path", lambda turn: turn["checksum"]).alias("checksums"),
        F.transform("path", lambda turn: turn["chars"]).alias("chars"),
    )
    return staged(first.join(_end_hashes(keyed), "end").join(shown, "conv_id"), "paths")


# ---- double arrays ---------------------------------------------------------------------


class DoubleArray:
    """Trie of paths of turn numbers, as the arrays BASE and CHECK; slot 0 is the root.

    ``codes`` holds the numbers, from 0 on, of all paths one after another and ``lengths`` how many each has.
    """

    def __init__(self, codes: np.ndarray, lengths: np.ndarray):
        self.begin = np.cumsum(lengths) - lengths
        self.lengths, self.codes = lengths, codes
        self.base = np.zeros(1, np.int64)
        self.check = np.zeros(1, np.int64)
        self._grow(2 * len(codes) + 2)
        self.check[0] = 0
        slots = np.zeros(len(lengths), np.int64)
        for depth, of in self._levels():
            slots[of] = self._add(slots[of], codes[self.begin[of] + depth])

    def _levels(self):
        """Depth of a turn, and the paths that reach it."""
        of = np.arange(len(self.lengths))
        depth = 0
        while len(of := of[self.lengths[of] > depth]):
            yield depth, of
            depth += 1

    def _grow(self, size: int) -> None:
        if size > len(self.check):
            size = max(size, 2 * len(self.check))
            base, check = np.zeros(size, np.int64), np.full(size, -1, np.int64)
            base[: len(self.base)], check[: len(self.check)] = self.base, self.check
            self.base, self.check = base, check

    def _free(self, n: int) -> np.ndarray:
        """The first ``n`` slots that are free."""
        free = np.flatnonzero(self.check < 0)
        if len(free) < n:
            self._grow(len(self.check) + n)
            free = np.flatnonzero(self.check < 0)
        return free[:n]

    def _add(self, parents: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Slots of the children of nodes by codes, which may repeat; the nodes have none so far."""
        order = np.lexsort((codes, parents))
        p, c = parents[order], codes[order]
        new = np.ones(len(p), bool)
        new[1:] = (p[1:] != p[:-1]) | (c[1:] != c[:-1])
        p, c = p[new], c[new]
        head = np.ones(len(p), bool)
        head[1:] = p[1:] != p[:-1]
        heads = np.flatnonzero(head)
        sizes = np.diff(np.append(heads, len(p)))
        # Families are placed one by one where they fit, only children in the slots that are left.
        for at in np.flatnonzero(sizes > 1):
            family = c[heads[at] : heads[at] + sizes[at]]
            base = self._fit(family)
            self._grow(base + int(family[-1]) + 1)
            self.base[p[heads[at]]] = base
            self.check[base + family] = p[heads[at]]
        single = heads[sizes == 1]
        free = self._free(len(single))
        self.base[p[single]] = free - c[single]
        self.check[free] = p[single]
        return self.base[parents] + codes

    def _fit(self, family: np.ndarray) -> int:
        """A base from which all slots of a family are free."""
        offsets = family - family[0]
        free = np.flatnonzero(self.check < 0)
        free = free[free < len(self.check) - offsets[-1]]
        for some in np.array_split(free, max(1, len(free) * len(family) // 500_000 + 1)):
            fits = (self.check[some[:, None] + offsets] < 0).all(axis=1)
            if fits.any():
                return int(some[np.argmax(fits)] - family[0])
        return len(self.check) - int(family[0])

    def child(self, slots: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Slots of children; -1 where there is none."""
        at = self.base[slots] + codes
        inside = (at > 0) & (at < len(self.check))
        at = np.where(inside, at, 0)
        return np.where(inside & (self.check[at] == slots), at, -1)

    def walk(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """By depth: the paths that reach it, the slots they are at, and places of their turns."""
        slots = np.zeros(len(self.lengths), np.int64)
        for depth, of in self._levels():
            places = self.begin[of] + depth
            slots[of] = self.child(slots[of], self.codes[places])
            yield of, slots[of], places


def _measured(rows: list[dict]) -> pa.Table:
    """Nodes of some shards from their paths, below their upper nodes."""
    cut = np.array([row["cut"] for row in rows], np.int64)
    checksums = pa.array([sum_ for row in rows for sum_ in row["checksums"][row["cut"] - 1 :]], pa.binary())
    chars = np.array([n for row in rows for n in row["chars"][row["cut"] - 1 :]], np.int64)
    lengths = np.array([len(row["chars"]) for row in rows], np.int64) - cut + 1
    # Shards hang beside each other below the root, each by the key of its top.
    dense = checksums.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    begin = np.cumsum(lengths) - lengths
    tops: dict[bytes, int] = {}
    dense += len(rows)
    dense[begin] = [tops.setdefault(row["shard"], len(tops)) for row in rows]
    trie = DoubleArray(dense, lengths)

    size = len(trie.check)
    n_convs, length, children, depth_of = (np.zeros(size, np.int64) for _ in range(4))
    smallest = np.full(size, np.iinfo(np.int64).max)
    count = np.array([row["n_convs"] for row in rows], np.int64)
    ids = np.array([row["conv_id"] for row in rows], np.int64)
    ending = np.full(size, -1, np.int64)
    top = np.full(size, -1, np.int64)
    levels = []
    for of, slots, places in trie.walk():
        np.add.at(n_convs, slots, count[of])
        np.minimum.at(smallest, slots, ids[of])
        length[slots] = chars[places]
        depth_of[slots] = cut[of] + len(levels)
        last = lengths[of] == len(levels) + 1
        ending[slots[last]] = of[last]
        if not levels:
            top[slots] = of
        levels.append(np.unique(slots))
    for level in levels[1:]:
        np.add.at(children, trie.check[level], 1)
    leaves = (children == 0).astype(np.int64)
    saved = (n_convs - 1) * length
    for level in levels[:0:-1]:
        np.add.at(leaves, trie.check[level], leaves[level])
        np.add.at(saved, trie.check[level], saved[level])
    nodes = np.concatenate(levels)
    parents = trie.check[nodes]
    above = [rows[i]["above"] if i >= 0 else None for i in top[nodes].tolist()]
    return pa.table(
        {
            "conv_id": smallest[nodes],
            "depth": depth_of[nodes],
            "parent_conv_id": pa.array(smallest[parents], mask=parents == 0),
            "n_convs": n_convs[nodes],
            "n_children": children[nodes],
            "n_leaves": leaves[nodes],
            "saved_tokens": saved[nodes],
            "ends_sha256": pa.array(
                [rows[i]["ends_sha256"] if i >= 0 else NOTHING for i in ending[nodes].tolist()], pa.string()
            ),
            "above": pa.array(above, pa.list_(pa.struct([("key", pa.binary()), ("chars", pa.int64())]))),
        }
    )


_NODES = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long,"
    " saved_tokens long, ends_sha256 string, above array<struct<key:binary,chars:bigint>>"
)


def _shard_nodes(most: int):
    """Function over paths in the order of their shards; some whole shards make a trie at a time."""

    def nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, turns, shard = [], 0, None
        for batch in batches:
            for row in batch.to_pylist():
                if turns >= most and row["shard"] != shard:
                    yield from _measured(rows).to_batches()
                    rows, turns = [], 0
                rows.append(row)
                shard = row["shard"]
                turns += len(row["chars"]) - row["cut"] + 1
        if rows:
            yield from _measured(rows).to_batches()

    return nodes


# ---- shards ----------------------------------------------------------------------------


def _cuts(found: DataFrame, most: int) -> DataFrame:
    """(end, upper): how many upper nodes, from the first turn on, a path has; for paths that have some."""
    steps = found.select("end", F.size("keys").cast("long").alias("turns"), F.posexplode("keys").alias("at", "key"))
    large = (
        steps.groupBy("key")
        .agg(F.sum("turns").alias("turns"), F.count(F.lit(1)).alias("paths"))
        .where((F.col("turns") > most) & (F.col("paths") > 1))
        .select("key")
    )
    met = lookup_join(steps.select("end", "at", "key"), staged(large, "upper-keys"), "key")
    return met.groupBy("end").agg((F.max("at") + 1).alias("upper"))


def _chains(tops: DataFrame) -> DataFrame:
    """Each top's upper nodes, the root included: conv_id, measures, key, chars, depth, last."""
    root = F.array(F.struct(F.lit(b"").alias("key"), F.lit(0).cast("long").alias("chars")))
    return tops.select(
        "conv_id",
        "n_convs",
        "n_leaves",
        "saved_tokens",
        "ends_sha256",
        "ends",
        F.size("above").alias("last"),
        F.posexplode(F.concat(root, F.col("above"))).alias("depth", "node"),
    ).select("*", "node.key", "node.chars").drop("node")


def prefix_trie(convs: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    ``convs`` has conv_id, each once, and path, as ``conversations`` gives them.  A node is a beginning of a path; the
    root, depth 0, is the beginning of all.  conv_id is the smallest of the conversations that
    begin so.  A conversation without turns ends at the root.  No conversations give no node, not even the root.
    The result is the same whatever ``shard_turns``.  A task holds the paths of one shard, which
    is a single path of any length or as many as have ``shard_turns`` turns together.
    """
    found = paths(convs)
    cuts = lookup_join(found, staged(_cuts(found, shard_turns), "cuts"), "end", "left")
    above = F.transform(
        F.sequence(F.lit(1), F.col("upper")),
        lambda i: F.struct(F.get("keys", i - 1).alias("key"), F.get("chars", i - 1).alias("chars")),
    )
    none = F.array().cast("array<struct<key:binary,chars:bigint>>")
    placed = staged(
        cuts.withColumn("upper", F.coalesce("upper", F.lit(0))).select(
            "conv_id",
            "n_convs",
            "ends_sha256",
            "checksums",
            "chars",
            (F.col("upper") + 1).alias("cut"),
            F.get("keys", F.col("upper")).alias("shard"),
            F.when(F.col("upper") > 0, above).otherwise(none).alias("above"),
        ),
        "placed-paths",
    )
    low = staged(
        placed.where("shard is not null")
        .repartition("shard")
        .sortWithinPartitions("shard")
        .mapInArrow(_shard_nodes(shard_turns), _NODES),
        "shard-nodes",
    )
    ended = placed.where("shard is null").select(
        "conv_id",
        "n_convs",
        F.lit(0).cast("long").alias("n_leaves"),
        F.lit(0).cast("long").alias("saved_tokens"),
        "ends_sha256",
        F.lit(True).alias("ends"),
        "above",
    )
    tops = low.where("above is not null").withColumn("ends", F.lit(False)).select(*ended.columns).unionByName(ended)
    upper = _upper_nodes(tops)
    parents = upper.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent"))
    last = F.coalesce(F.try_element_at("above", F.lit(-1))["key"], F.lit(b""))
    rest = low.where("above is null").drop("above")
    joined = lookup_join(
        low.where("above is not null").withColumn("parent_key", last).drop("above"), parents, "parent_key"
    ).withColumn("parent_conv_id", F.col("parent"))
    return (
        rest.unionByName(joined.select(*rest.columns))
        .unionByName(upper.select(*rest.columns))
        .select(*rest.columns)
    )


def _upper_nodes(tops: DataFrame) -> DataFrame:
    """Upper nodes with their keys, from what the tops below and the paths that end at them sum up."""
    chains = _chains(tops)
    child = ~F.col("ends") & (F.col("depth") == F.col("last"))
    nodes = staged(
        chains.groupBy("key").agg(
            F.min("conv_id").alias("conv_id"),
            F.min("depth").cast("long").alias("depth"),
            F.max("chars").alias("chars"),
            F.sum("n_convs").alias("n_convs"),
            F.sum("n_leaves").alias("n_leaves"),
            F.sum("saved_tokens").alias("saved_tokens"),
            F.count(F.when(child, 1)).alias("n_children"),
            F.max(F.when(F.col("ends") & (F.col("depth") == F.col("last")), F.col("ends_sha256"))).alias("sha"),
        ),
        "upper-nodes",
    )
    # An upper node is on the way to its smallest conversation, which is the smallest of one top.
    owners = nodes.select("conv_id").distinct()
    ways = tops.select("conv_id", "above").join(owners, "conv_id", "left_semi")
    of = nodes.select("conv_id", "key", "depth", ((F.col("n_convs") - 1) * F.col("chars")).alias("own"))
    root = F.array(F.lit(b""))
    ways = ways.select("conv_id", F.concat(root, F.transform("above", lambda node: node["key"])).alias("way"))
    passed = staged(
        of.join(ways, "conv_id").select(
            "own", "depth", F.posexplode(F.slice("way", F.lit(1), (F.col("depth") + 1).cast("int"))).alias("at", "over")
        ),
        "upper-ways",
    )
    sums = passed.groupBy(F.col("over").alias("key")).agg(
        F.sum("own").alias("upper_saved"),
        # Steps from a node to one just below it.
        F.count(F.when(F.col("at") == F.col("depth") - 1, 1)).alias("upper_children"),
    )
    parents = (
        of.join(ways, "conv_id")
        .where("depth > 0")
        .select("key", F.get("way", (F.col("depth") - 1).cast("int")).alias("over"))
    )
    named = nodes.select(F.col("key").alias("over"), F.col("conv_id").alias("parent_conv_id"))
    whole = (
        nodes.join(sums, "key")
        .join(parents, "key", "left")
        .join(named, "over", "left")
        .select(
            "key",
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            (F.col("n_children") + F.col("upper_children")).alias("n_children"),
            # A path that ends at the root, where nothing else is, is its leaf.
            F.when(F.col("n_children") + F.col("upper_children") == 0, 1).otherwise(F.col("n_leaves")).cast("long").alias("n_leaves"),
            (F.col("saved_tokens") + F.col("upper_saved")).alias("saved_tokens"),
            F.coalesce("sha", F.lit(NOTHING)).alias("ends_sha256"),
        )
    )
    return staged(whole, "upper")
