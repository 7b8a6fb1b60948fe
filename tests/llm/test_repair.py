"""Repaired conversations against a plain search over edits, and damage written out."""

import hashlib
import heapq
import random
import re
import zlib

import pytest

from grantlens.llm import repair

GRAMMAR = re.compile("(s?(ua)+)?")
WHITE = " \t\n\x0b\x0c\r"


def _plain(rows):
    """All columns of the report for turns in order, by a search of the cheapest edits."""
    seen, faults = set(), []
    for _, role, text in rows:
        bare = text.rstrip(WHITE)
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None
        seen.add((role, text))
        faults.append(fault)
    initials = [role[:1] for _, role, _ in rows]
    # The search goes by cost, then by audit; states are the turns done and the roles so far.
    heap, best = [(0, "", 0, "", ())], None
    visited = set()
    while heap:
        cost, audit, at, roles, out = heapq.heappop(heap)
        if at == len(rows) and GRAMMAR.fullmatch(roles):
            best = cost, audit, out
            break
        key = at, roles[-1:] if len(roles) > 1 or roles != "s" else "S", roles == ""
        if key in visited:
            continue
        visited.add(key)
        for role in ("user", "assistant"):
            if _leads(roles + role[0]):
                heapq.heappush(heap, (cost + 5, audit + "I", at, roles + role[0], (*out, f"{role}:")))
        if at == len(rows):
            continue
        _, role, text = rows[at]
        heapq.heappush(heap, (cost + 2, audit + "D", at + 1, roles, out))
        if faults[at] in ("blank", "duplicate"):
            continue
        extra = 5 if faults[at] else 0
        if role[:1] in ("s", "u", "a") and _leads(roles + role[0]):
            heapq.heappush(heap, (cost + extra, audit + "K", at + 1, roles + role[0], (*out, f"{role}:{text}")))
        for other in ("user", "assistant"):
            if _leads(roles + other[0]):
                heapq.heappush(heap, (cost + extra + 1, audit + "R", at + 1, roles + other[0], (*out, f"{other}:{text}")))
    turns = [turn for turn, _, _ in rows if turn is not None]
    return (
        max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        *[faults.count(fault) for fault in ("blank", "duplicate", "truncated")],
        sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
        best[0],
        best[1],
        hashlib.sha256("\n".join(best[2]).encode()).hexdigest(),
    )


def _leads(roles):
    return re.fullmatch("s?(ua)*u?", roles)


def _ordered(rows):
    checksum = lambda text: hashlib.md5(text.encode()).digest()
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], checksum(r[2])))


def _expected(conversations):
    """Reports of damaged conversations, damage included."""
    found = {}
    for conv, turn, role, text in conversations:
        rows = found.setdefault(conv, [])
        spelt = [" " if x is None else str(x) for x in (conv, turn)]
        kind = zlib.crc32(":".join(spelt).encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 1:
            text = ""
        elif kind == 2:
            text = re.sub("[.!?]", "", text)
        elif kind == 4:
            role = "user"
        rows += [(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return {conv: _plain(_ordered(rows)) for conv, rows in found.items()}


def _report(df):
    return {row.conv_id: tuple(row)[1:] for row in df.collect()}


def test_nodes_give_the_cheapest_edits():
    draw = random.Random(3)
    texts = {"x": "", "plain": "Done.", "open": "Not done"}
    for _ in range(1500):
        rows = [
            (i, draw.choice(["system", "user", "assistant", "tool"]), draw.choice(list(texts.values())) .replace("o", f"{i}o"))
            for i in range(draw.randrange(8))
        ]
        letters = "".join(
            "x" if not text else (role[0] if role[0] in "sua" else "o").upper() if text[-1] != "." else (role[0] if role[0] in "sua" else "o")
            for _, role, text in rows
        )
        nodes = [repair.LAST]
        for letter in reversed(letters):
            nodes.append(repair.node_before(letter, nodes[-1]))
        assert (nodes[-1][0][0], repair.read_audit(letters, nodes)) == _plain(rows)[5:7]


def test_reports_of_damaged_conversations(spark):
    draw = random.Random(8)
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None]
    rows = []
    for conv in [*range(150), None, -7]:
        for turn in range(draw.randrange(1, 12)):
            number = draw.choice([turn, turn, turn, turn, None, turn * 3])
            text = draw.choice(["Yes.", "No", None, "", " \t\n", f"Well {turn}!", "So\x0b? \n", "x" * 9000])
            rows.append((conv, number, draw.choice(roles), text))
    rows += rows[::17]
    turns = spark.createDataFrame(
        [(*row, "extra", 1) for row in rows], "conv_id long, turn long, role string, text string, plan string, present int"
    ).repartition(5)
    got = _report(repair.repair_report(repair.damaged(turns), present="present"))
    assert got == _expected(rows)


def test_repaired_turns(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "user", "There."), (1, 2, "assistant", ""), (2, 0, "assistant", "So.")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = sorted(map(tuple, repair.repaired_turns(turns).collect()))
    assert got == [(1, 0, "user", "Hi.", "K"), (1, 1, "assistant", "There.", "R")]
    assert _report(repair.repair_report(turns))[2][4:7] == (0, 2, "D")


def test_a_query_of_the_small_tables(spark, small_tables):
    from grantlens.llm.queries import QUERIES

    rows = [tuple(r) for r in spark.read.parquet(f"{small_tables}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert _report(QUERIES["op13_structure_repair"](spark, small_tables)) == _expected(rows)


def test_no_conversations(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert repair.repair_report(repair.damaged(empty), present="present").count() == 0
    assert repair.repaired_turns(empty).count() == 0
