"""Repair of damaged conversations at the least cost.

Every turn becomes one letter: its role, in capitals if its text breaks off, or ``x`` if it has to go.  The letters
of a conversation are its signature.  How to go on depends only on what is left of a signature
and on the state of the role grammar, so signatures are read from the end: the
different ones of all conversations are sorted by their reversed letters, equal ends meet, and each
end is one node of an automaton that all signatures share.  A node holds, for each
grammar state, the least cost to go and the first edit of the best audit.  It is worked out
from the node after it once.  An audit is read off by walking on from node to node.

Only the short facts of turns take part in that; texts travel once, with the edits of their conversation, and
are edited and hashed as they stream by.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from grantlens.operators.joins import lookup_join
from grantlens.session import staged

# ---- fixed values -----------------------------------------------------------
DELETE_COST, INSERT_COST, REROLE_COST, TRUNCATED_COST = 2, 5, 1, 5
WHITE = r"[\x20\x09-\x0D]"
ENDS = r"[.!?]"
# Grammar s?(ua)+ or nothing.  States: at the start, after the system's turn, after the user's, after
# the assistant's.  Each has one role among user and assistant that can come next.
NEXT = (2, 2, 3, 2)
ROLES = ("user", "user", "assistant", "user")
KEEPS = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
# -----------------------------------------------------------------------------

# Of edits that cost the same the one whose initial comes first: Delete, Insert, Keep, Rerole.
Node = tuple[tuple[int, str], ...]
LAST: Node = ((0, ""), (2 * INSERT_COST, "I"), (INSERT_COST, "I"), (0, ""))


def node_before(letter: str, after: Node) -> Node:
    """Cost to go and first edit, for each grammar state, of a letter and what follows it."""
    found = []
    for state in range(4):
        choices = [(DELETE_COST + after[state][0], "D")]
        if letter != "x":
            extra = TRUNCATED_COST if letter.isupper() else 0
            kept = KEEPS.get((state, letter.lower()))
            if kept is not None:
                choices.append((extra + after[kept][0], "K"))
            choices.append((extra + REROLE_COST + after[NEXT[state]][0], "R"))
        found.append(min(choices))
    # Two insertions in a row come back to the state before them, so one is enough after a user's or an assistant's turn.
    user, assistant = found[2], found[3]
    found[2] = min(user, (INSERT_COST + assistant[0], "I"))
    found[3] = min(assistant, (INSERT_COST + user[0], "I"))
    found[0] = min(found[0], (INSERT_COST + found[2][0], "I"))
    found[1] = min(found[1], (INSERT_COST + found[2][0], "I"))
    return tuple(found)


def read_audit(signature: str, nodes: list[Node]) -> str:
    """Edits of a signature; ``nodes[n]`` is the node of its last n letters."""
    state, left, audit = 0, len(signature), []
    while edit := nodes[left][state][1]:
        audit.append(edit)
        if edit == "K":
            state = KEEPS[state, signature[-left].lower()]
        elif edit != "D":
            state = NEXT[state]
        left -= edit != "I"
    return "".join(audit)


def _solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(signature, cost, audit) of reversed signatures in order."""
    path, nodes = "", [LAST]
    for batch in batches:
        signatures, costs, audits = [], [], []
        for letters in batch.column(0).to_pylist():
            shared = 0
            for a, b in zip(path, letters):
                if a != b:
                    break
                shared += 1
            # What the last signature and this one end with is there already.
            del nodes[shared + 1 :]
            for letter in letters[shared:]:
                nodes.append(node_before(letter, nodes[-1]))
            path = letters
            signatures.append(letters[::-1])
            costs.append(nodes[-1][0][0])
            audits.append(read_audit(signatures[-1], nodes))
        yield pa.RecordBatch.from_arrays(
            [pa.array(signatures, pa.string()), pa.array(costs, pa.int64()), pa.array(audits, pa.string())],
            ["signature", "cost", "audit"],
        )


def solve(signatures: DataFrame) -> DataFrame:
    """(signature, cost, audit) of each different signature; the column is read several times, so it is to be staged."""
    ends = signatures.select(F.reverse("signature").alias("ends")).distinct()
    return (
        ends.repartitionByRange("ends")
        .sortWithinPartitions("ends")
        .mapInArrow(_solved, "signature string, cost long, audit string")
    )


# ---- turns -----------------------------------------------------------------------------


def _filled(turns: DataFrame, conv: str, present: str | None) -> DataFrame:
    return turns.select(
        F.col(conv).alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
        (F.coalesce(F.col(present), F.lit(False)) if present else F.lit(True)).alias("here"),
    )


def _checksum(text: Column) -> Column:
    return F.unhex(F.md5(text))


def facts(filled: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, signature."""
    small = filled.select(
        "conv_id",
        "turn",
        "role",
        "here",
        _checksum(F.col("text")).alias("checksum"),
        (~F.col("text").rlike(rf"[^\x20\x09-\x0D]")).alias("blank"),
        (~F.col("text").rlike(rf"{ENDS}{WHITE}*\z")).alias("open"),
    )
    same = Window.partitionBy("conv_id", "here", "role", "checksum").orderBy(F.asc_nulls_first("turn"))
    order = Window.partitionBy("conv_id", "here").orderBy(F.asc_nulls_first("turn"), "role", "checksum")
    initial = F.substring("role", 1, 1)
    placed = (
        small.withColumn("again", ~F.col("blank") & (F.row_number().over(same) > 1))
        .withColumn("open", ~F.col("blank") & ~F.col("again") & F.col("open"))
        .withColumns(
            {
                "pos": F.row_number().over(order),
                "pair": F.concat(F.lag(initial).over(order), initial),
                "before": F.lag("turn").over(order),
            }
        )
    )
    known = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    letter = F.when(F.col("blank") | F.col("again"), "x").when(F.col("open"), F.upper(known)).otherwise(known)

    def count(condition: Column) -> Column:
        return F.count(F.when(F.col("here") & condition, 1))

    spread = F.max(F.when(F.col("here"), F.col("turn"))) - F.min(F.when(F.col("here"), F.col("turn"))) + 1
    distinct = count(F.col("turn").isNotNull() & ~F.col("turn").eqNullSafe(F.col("before")))
    letters = F.sort_array(F.collect_list(F.when(F.col("here"), F.struct("pos", letter.alias("letter")))))
    return placed.groupBy("conv_id").agg(
        F.coalesce(spread - distinct, F.lit(0)).cast("long").alias("gaps"),
        count(F.col("blank")).alias("blank"),
        count(F.col("again")).alias("duplicate"),
        count(F.col("open")).alias("truncated"),
        count(F.col("pair").isNotNull() & ~F.col("pair").isin("su", "ua", "au")).alias("illegal"),
        F.array_join(F.transform(letters, lambda one: one["letter"]), "").alias("signature"),
    )


REPORT = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")


def _edits(turns: DataFrame, conv: str, present: str | None) -> DataFrame:
    """Facts and edits of each conversation, then its turns, in order in one partition."""
    filled = _filled(turns, conv, present)
    known = staged(facts(filled), "conversation-facts")
    plans = lookup_join(known, staged(solve(known), "signatures"), "signature")
    kind = turns.schema[conv].dataType.simpleString()
    empty = {"turn": "long", "role": "string", "text": "string", "checksum": "binary"}
    plans = plans.select(
        "conv_id", F.struct(*REPORT).alias("plan"), *[F.lit(None).cast(t).alias(name) for name, t in empty.items()]
    )
    rows = filled.where("here").select(
        "conv_id", F.lit(None).cast(plans.schema["plan"].dataType).alias("plan"), "turn", "role", "text",
        _checksum(F.col("text")).alias("checksum"),
    )
    return (
        plans.unionByName(rows)
        .select(F.col("conv_id").cast(kind).alias("conv_id"), "plan", "turn", "role", "text", "checksum")
        .repartition("conv_id")
        .sortWithinPartitions(
            F.asc_nulls_first("conv_id"), F.col("plan").isNull(), F.asc_nulls_first("turn"), "role", "checksum"
        )
    )


def _applied(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(conv_id, plan, None) at the start of each conversation, then (role, text, edit) of each repaired turn."""
    audit, done, state = "", 0, 0
    for batch in batches:
        columns = [batch.column(i).to_pylist() for i in (0, 1, 3, 4)]
        for conv, plan, role, text in zip(*columns):
            if plan is not None:
                audit, done, state = plan["audit"], 0, 0
                yield conv, plan, None
            else:
                edit, done = audit[done], done + 1
                if edit == "K":
                    state = KEEPS[state, role[:1]]
                    yield role, text, edit
                elif edit == "R":
                    role, state = ROLES[state], NEXT[state]
                    yield role, text, edit
            # Turns put in before the next one, or at the end.
            while audit[done : done + 1] == "I":
                yield ROLES[state], "", "I"
                done, state = done + 1, NEXT[state]


def repaired_turns(turns: DataFrame, conv: str = "conv_id", present: str | None = None) -> DataFrame:
    """Turns of the repaired conversations: conv_id, position, role, text, edit (K kept, R given another role, I put in).

    Takes what ``repair_report`` takes.
    """
    kind = turns.schema[conv].dataType.simpleString()
    schema = f"conv_id {kind}, position long, role string, text string, edit string"
    arrow = pa.schema([("position", pa.int64()), *[(n, pa.string()) for n in ("role", "text", "edit")]])

    def rows(batches):
        convs, out, current, position, size = [], [], None, 0, 0

        def batch():
            made = pa.RecordBatch.from_pylist(out, arrow)
            return pa.RecordBatch.from_arrays([pa.array(convs, batch_type[0]), *made.columns], ["conv_id", *arrow.names])

        batch_type = []

        def watched():
            for one in batches:
                batch_type[:] = [one.schema.field(0).type]
                yield one

        for a, b, edit in _applied(watched()):
            if edit is None:
                current, position = a, 0
                continue
            convs.append(current)
            out.append({"position": position, "role": a, "text": b, "edit": edit})
            position, size = position + 1, size + len(b) + 64
            if size > 4_000_000:
                yield batch()
                convs, out, size = [], [], 0
        if out:
            yield batch()

    return _edits(turns, conv, present).mapInArrow(rows, schema)


def repair_report(turns: DataFrame, conv: str = "conv_id", present: str | None = None) -> DataFrame:
    """One row per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    ``turns`` has turn, role and text.  Where the column named ``present`` is not true a row only says that
    there is such a conversation; one without other rows has zeros, an empty audit and the hash of
    nothing.  NULL roles and texts count as one space.  Turns go by number, NULL first, equal ones by role and
    checksum of the text; a row that repeats another is a duplicate.  A role whose initial is none of s, u, a can not
    be kept.  Rows with a NULL id are one conversation.  An empty table gives an empty result; other columns are not
    read.  A task holds the letters of one conversation at a time, never its texts.
    """
    kind = turns.schema[conv].dataType.simpleString()
    schema = f"conv_id {kind}, {', '.join(f'{name} long' for name in REPORT[:-1])}, audit string, repaired_sha256 string"

    def rows(batches):
        kinds, convs, plans, hashes = [], [], [], []
        digest, begun = None, False

        def watched():
            for one in batches:
                kinds[:] = [one.schema.field(0).type]
                yield one

        def batch(n):
            made = [pa.array([plan[name] for plan in plans[:n]]) for name in REPORT]
            made[-1] = made[-1].cast(pa.string())
            return pa.RecordBatch.from_arrays(
                [pa.array(convs[:n], kinds[0]), *made, pa.array(hashes[:n], pa.string())],
                ["conv_id", *REPORT, "repaired_sha256"],
            )

        for a, b, edit in _applied(watched()):
            if edit is None:
                if digest:
                    hashes.append(digest.hexdigest())
                if len(hashes) == 5000:
                    yield batch(5000)
                    convs, plans, hashes = [], [], []
                convs.append(a)
                plans.append(b)
                digest, begun = hashlib.sha256(), False
            else:
                digest.update((("\n" if begun else "") + f"{a}:{b}").encode())
                begun = True
        if digest:
            hashes.append(digest.hexdigest())
            yield batch(len(hashes))

    return _edits(turns, conv, present).mapInArrow(rows, schema)


def damaged(conversations: DataFrame) -> DataFrame:
    """Conversations with faults that follow from conv_id and turn: conv_id, turn, role, text, present.

    Of twenty turns on average one is dropped (its row stays, without ``present``), one loses its text, one its
    sentence ends, one is repeated and one given to the user.  NULLs become one space first.
    """

    def spelt(name):
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(spelt("conv_id"), F.lit(":"), spelt("turn"))) % 20
    text = spelt("text")
    return (
        conversations.select(
            "conv_id",
            "turn",
            F.when(kind == 4, "user").otherwise(spelt("role")).alias("role"),
            F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, ENDS, "")).otherwise(text).alias("text"),
            (kind != 0).alias("present"),
            F.explode(F.when(kind == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"),
        )
        .drop("copy")
    )
