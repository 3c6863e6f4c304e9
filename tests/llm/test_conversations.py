"""Conversation repair against all edits of short conversations, and against a plain version over long ones."""

import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from tagwright.llm import conversations
from tagwright.llm.queries import ORACLE_SQL, QUERIES
from tests.oracle import assert_same

SCHEMA = "conv_id long, turn long, role string, text string"


def faults(turns):
    seen, out = set(), []
    for _, role, text in turns:
        body = text.strip(" \t\n\x0b\x0c\r")
        out.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def all_edits(turns, found):
    """Cost, audit and lines of every way to edit, with at most two inserts in a row."""
    edits = [("D",) if f in ("blank", "duplicate") else ("K", "Ru", "Ra", "D") for f in found]
    fills = [x for n in range(3) for x in itertools.product("ua", repeat=n)]
    for chosen in itertools.product(*edits):
        for inserted in itertools.product(fills, repeat=len(turns) + 1):
            cost, audit, lines = 0, "", []
            for k, fill in enumerate(inserted):
                cost, audit, lines = cost + 3 * len(fill), audit + "I" * len(fill), lines + [({"u": "user", "a": "assistant"}[c], "") for c in fill]
                if k < len(turns):
                    edit, (_, role, text) = chosen[k], turns[k]
                    audit += edit[0]
                    cost += {"K": 0, "R": 3, "D": 4}[edit[0]] + 3 * (found[k] == "truncated" and edit != "D")
                    if edit != "D":
                        lines.append((role if edit == "K" else {"u": "user", "a": "assistant"}[edit[1]], text))
            yield cost, audit, lines


def legal(lines):
    return re.fullmatch(r"(s?(ua)+)?", "".join(r[:1] or "?" for r, _ in lines)) is not None


def plain(turns):
    """The same by dynamic programming over states, one turn after the other."""
    ways = {"0": (0, "", ())}

    def offer(table, state, way):
        if state not in table or way[:2] < table[state][:2]:
            table[state] = way

    def insert(table):
        for _ in range(2):
            for state, (c, a, t) in list(table.items()):
                to = "a" if state == "u" else "u"
                offer(table, to, (c + 3, a + "I", (*t, ("user" if to == "u" else "assistant", ""))))

    for (_, role, text), fault in zip(turns, faults(turns), strict=True):
        insert(ways)
        after = {}
        for state, (c, a, t) in ways.items():
            offer(after, state, (c + 4, a + "D", t))
            if fault in ("blank", "duplicate"):
                continue
            c += 3 * (fault == "truncated")
            to = "a" if state == "u" else "u"
            offer(after, to, (c + 3, a + "R", (*t, ("user" if to == "u" else "assistant", text))))
            if role[:1] == to or role[:1] == "s" and state == "0":
                offer(after, role[:1], (c, a + "K", (*t, (role, text))))
        ways = after
    insert(ways)
    return min((ways[s] for s in ("0", "a") if s in ways), key=lambda w: w[:2])


@pytest.fixture()
def small_tree(monkeypatch):
    """So few turns a chunk and parts a step that the tree has many levels."""
    monkeypatch.setattr(conversations, "CHUNK_BITS", 1)
    monkeypatch.setattr(conversations, "FAN_BITS", 1)


def check(spark, rows):
    table = spark.createDataFrame(rows, SCHEMA).repartition(5).withColumns({c: F.lit("x") for c in ("conv", "at", "key", "audit", "chunk", "n", "ordinal")})
    found = conversations.repair(table)
    got = {r.conv: r for r in found.summary.collect()}
    repaired = {}
    for r in sorted(found.repaired().collect(), key=lambda r: r.place):
        repaired.setdefault(r.conv, []).append((r.role, r.text))
    digests = {r.conv: r.repaired_sha256 for r in found.digests().collect()}
    by = {}
    for c, *turn in rows:
        by.setdefault("-" if c is None else f"+{c}", []).append((turn[0], *(" " if x is None else x for x in turn[1:])))
    assert set(got) == set(by) == set(digests)
    for conv, turns in by.items():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1].encode(), t[2].encode()))
        cost, audit, lines = plain(turns)
        numbers, kinds = [t[0] for t in turns if t[0] is not None], faults(turns)
        r = got[conv]
        assert (r.cost, r.audit, repaired.get(conv, [])) == (cost, audit, list(lines))
        assert r.gaps == (max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0)
        assert (r.blank, r.duplicate, r.truncated) == tuple(kinds.count(k) for k in ("blank", "duplicate", "truncated"))
        assert r.illegal == sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:]))
        assert digests[conv] == hashlib.sha256("\n".join(f"{a}:{b}" for a, b in lines).encode()).hexdigest()


def test_plain_version_and_product_equal_all_edits():
    rng = random.Random(3)
    for _ in range(150):
        turns = [(k, rng.choice(["user", "assistant", "system", "tool", ""]), rng.choice(["Yes.", "No", "", "Yes.", "Why?", f"t{k}."])) for k in range(rng.randrange(1, 4))]
        found = faults(turns)
        want = min((cost, audit, lines) for cost, audit, lines in all_edits(turns, found) if legal(lines))
        assert plain(turns)[:2] == want[:2] and list(plain(turns)[2]) == want[2]
        parts = [conversations.folded([(t, r[:1], f)]) for (t, r, _), f in zip(turns, found, strict=True)]
        whole = conversations.folded((t, r[:1], f) for (t, r, _), f in zip(turns, found, strict=True))
        left = right = parts[0]
        for p in parts[1:]:
            left = conversations.joined(left, p)
        for p in reversed(parts[:-1]):
            right = conversations.joined(p, parts[-1] if right is parts[0] else right)
        assert left == whole and (len(parts) == 1 or right == whole)


def test_long_conversations_across_chunks_and_partitions(spark, small_tree):
    rng = random.Random(5)
    rows = [(7, k, rng.choice(["user", "assistant", "assistant", "system", "x"]), rng.choice([f"Turn {k}.", f"Turn {k}", "Again!", " \n"])) for k in range(150)]
    rows += [(c, k * 2, rng.choice(["user", "assistant"]), f"{k % 3}?") for c in range(12) for k in range(rng.randrange(1, 7)) if c != 7]
    check(spark, rows)


def test_odd_conversations(spark, small_tree):
    rows = [(None, None, None, None), (None, 3, "user", None), (None, 3, "user", "A."), (1, None, "assistant", "B."), (1, None, "user", "A."), (1, 0, "user", "A."), (1, 0, "user", "A.")]
    rows += [(2, 5, "", "x" * 200_000 + "."), (2, 9, "ümlaut", "漢字。"), (3, 1, "system", "S."), (4, -5, "user", "U."), (4, 5, "assistant", "W"), (4, 5, "assistant", "V.")]
    check(spark, rows)


def test_empty_tables_and_conversations_that_are_dropped(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert conversations.repair_report(none).count() == 0 and conversations.repair(none).repaired().count() == 0
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    row = conversations.repair_report(spark.createDataFrame([(gone, 0, "user", "U.")], SCHEMA)).first()
    assert row.asDict() == {"conv_id": gone, "gaps": 0, "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "cost": 0, "audit": "", "repaired_sha256": hashlib.sha256().hexdigest()}


def test_damage_by_a_hash(spark):
    rows = [(i, t, "assistant", f"Why {i}? So!") for i in [None, *range(60)] for t in (None, 0, 1)]
    want = []
    for i, t, role, text in rows:
        k = zlib.crc32(f"{' ' if i is None else i}:{' ' if t is None else t}".encode()) % 20
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        want += [(i, t, "user" if k == 4 else role, text)] * (0 if k == 0 else 2 if k == 3 else 1)
    got = [tuple(r) for r in conversations.damaged(spark.createDataFrame(rows, SCHEMA)).collect()]
    assert sorted(map(str, got)) == sorted(map(str, want)) and len({zlib.crc32(f"{i}:0".encode()) % 20 for i in range(60)} & {0, 1, 2, 3, 4}) == 5


def test_query_on_larger_tables(spark):
    sf = "/root/testdata/sf0.01"
    assert_same(QUERIES["op12_conversation_repair"](spark, sf), ORACLE_SQL["op12_conversation_repair"], sf)
