"""Structure repair of conversations, by a min-plus scan over 4x4 matrices.

The roles of a repaired conversation read `(s?(ua)+)?`: an optional system turn,
then user and assistant in turn, or nothing. Its automaton has four states: START,
SYSTEM (user must follow), USER (assistant must follow) and DONE. A turn is a
matrix over (cost, audit): the cheapest edits that lead from a state to a state
over this turn, inserts before it included. The product adds costs and joins
audits, and of two ways the cheaper stays, then the ASCII-least audit. Ways of one
cost from one state over the same turns are never prefixes of each other (more
inserts cost more), so the order of joined audits is that of their parts, and the
product is associative.

1. Turns get their positions in the global order of conversation and turn
   (ranges, so that one conversation may lie in many partitions).
2. Up to CHUNK turns of a conversation are folded to one matrix; with it go the
   other figures, which join in the same way.
3. Conversations of several chunks are reduced as a tree, FAN chunks a step.
4. The audit is replayed over the turns in order. A digest of a conversation's
   text has to be taken in order, so this step streams a conversation through one
   task, which holds the audit and one batch of turns.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import reduce
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagwright.llm.common import broadcast_up_to, discard, hub_join, keep
from tagwright.operators.ordering import ordinals

#: Turns folded at once (a power of two, as an exponent), and matrices a step of the tree.
CHUNK_BITS, FAN_BITS = 9, 6
REROLE, DELETE, INSERT, CUT = 3, 4, 3, 3
START, SYSTEM, USER, DONE = range(4)
#: State that a kept turn of this initial leads to, from each state.
_KEPT = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, DONE: USER}, "a": {USER: DONE}}
_NEXT = {START: USER, SYSTEM: USER, USER: DONE, DONE: USER}
_LEGAL = {"su", "ua", "au"}
_ROLE = {USER: "user", DONE: "assistant"}
BROADCAST_CONVERSATIONS = 1_000_000

Way = tuple[int, str]
Row = list[Way | None]


class Part(NamedTuple):
    """What is known of consecutive turns of a conversation."""

    first_turn: int | None
    last_turn: int | None
    low: int | None
    high: int | None
    turns: int
    first: str
    last: str
    blank: int
    duplicate: int
    truncated: int
    illegal: int
    matrix: list[Row]


def _least(ways: Iterable[Way | None]) -> Way | None:
    return min((w for w in ways if w is not None), default=None)


def _more(way: Way | None, cost: int, edit: str) -> Way | None:
    return way and (way[0] + cost, way[1] + edit)


def closed(ways: Row) -> Row:
    """Ways to the four states when turns may be inserted after them."""
    user = _least([ways[USER], *(_more(ways[k], INSERT, "I") for k in (START, SYSTEM, DONE))])
    return [ways[START], ways[SYSTEM], user, _least([ways[DONE], _more(user, INSERT, "I")])]


def over_turn(ways: Row, initial: str, fault: str) -> Row:
    """Ways after a turn, with what may be inserted before it."""
    before = closed(ways)
    after = [[_more(w, DELETE, "D")] for w in before]
    if fault not in ("blank", "duplicate"):
        cut = CUT if fault == "truncated" else 0
        for state, way in enumerate(before):
            if way is not None:
                after[_NEXT[state]].append(_more(way, REROLE + cut, "R"))
                if (to := _KEPT.get(initial, {}).get(state)) is not None:
                    after[to].append(_more(way, cut, "K"))
    return [_least(x) for x in after]


def product(a: list[Row], b: list[Row]) -> list[Row]:
    return [[_least((x[0] + y[0], x[1] + y[1]) for x, y in zip(row, column, strict=True) if x and y) for column in zip(*b, strict=True)] for row in a]


def _bound(pick, *values: int | None) -> int | None:
    return pick((v for v in values if v is not None), default=None)


def joined(a: Part, b: Part) -> Part:
    return Part(
        a.first_turn,
        b.last_turn,
        _bound(min, a.low, b.low),
        _bound(max, a.high, b.high),
        a.turns + b.turns - (a.last_turn is not None and a.last_turn == b.first_turn),
        a.first,
        b.last,
        a.blank + b.blank,
        a.duplicate + b.duplicate,
        a.truncated + b.truncated,
        a.illegal + b.illegal + (a.last + b.first not in _LEGAL),
        product(a.matrix, b.matrix),
    )


def folded(turns: Iterable[tuple[int | None, str, str]]) -> Part:
    """One part of turns (turn, initial, fault) in order, at least one."""
    turns = list(turns)
    matrix: list[Row] = [[(0, "") if i == j else None for j in range(4)] for i in range(4)]
    for _, initial, fault in turns:
        matrix = [over_turn(row, initial, fault) for row in matrix]
    numbers, faults, initials = [t for t, *_ in turns if t is not None], [f for *_, f in turns], [i for _, i, _ in turns]
    return Part(
        turns[0][0],
        turns[-1][0],
        _bound(min, *numbers),
        _bound(max, *numbers),
        len(set(numbers)),
        initials[0],
        initials[-1],
        faults.count("blank"),
        faults.count("duplicate"),
        faults.count("truncated"),
        sum(x + y not in _LEGAL for x, y in zip(initials, initials[1:], strict=False)),
        matrix,
    )


_NUMBERS = ("first_turn", "last_turn", "low", "high", "turns", "blank", "duplicate", "truncated", "illegal")
_PART = ", ".join(f"{x} long" for x in _NUMBERS) + ", first string, last string, costs array<long>, audits array<string>"
_PLACE = "conv string, conv_id long, chunk long, "


def _flat(part: Part) -> dict:
    ways = [w for row in part.matrix for w in row]
    return {x: getattr(part, x) for x in (*_NUMBERS, "first", "last")} | {"costs": [w and w[0] for w in ways], "audits": [w and w[1] for w in ways]}


def _part(row: dict) -> Part:
    ways = [None if c is None else (c, a) for c, a in zip(row["costs"], row["audits"], strict=True)]
    return Part(*(row[x] for x in Part._fields[:-1]), [ways[i : i + 4] for i in range(0, 16, 4)])


def _mapped(df: DataFrame, to: str, f) -> DataFrame:
    """Rows of df through f, a dictionary each, a batch at a time."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                yield pa.RecordBatch.from_pylist([f(r) for r in batch.slice(at, 256).to_pylist()], schema)

    kinds = {"string": pa.string(), "long": pa.int64(), "array<long>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string())}
    schema = pa.schema([(x.split()[0], kinds[x.split()[1]]) for x in to.split(", ")])
    return df.mapInArrow(rows, to)


def leaves(turns: DataFrame) -> DataFrame:
    """A part for each conversation and chunk of positions, from ordered turns."""
    space, key = r"\x20\x09-\x0D", F.sha2(F.concat("conv", F.lit("|"), F.length("role"), F.lit("|"), "role", "text"), 256)
    fault = F.when(~F.col("text").rlike(f"[^{space}]"), "blank").when(~F.col("text").rlike(rf"[.!?][{space}]*\z"), "truncated").otherwise("")
    light = keep(turns.select("conv", "conv_id", "turn", "at", F.substring("role", 1, 1).alias("initial"), fault.alias("fault"), F.unhex(key).alias("key")), "turns")
    firsts = keep(light.groupBy("key").agg(F.min("at").alias("first_at"), F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1"), "repeated")
    again = hub_join(light.select("key", "conv", "conv_id", "at"), firsts, "key").where("at <> first_at")
    rows = light.select("conv", "conv_id", F.struct("at", "turn", "initial", "fault").alias("row"))
    rows = rows.unionByName(again.select("conv", "conv_id", F.struct("at", F.lit(None).cast("long").alias("turn"), F.lit(None).cast("string").alias("initial"), F.lit("duplicate").alias("fault")).alias("row")))
    chunks = rows.groupBy("conv", "conv_id", F.shiftright("row.at", CHUNK_BITS).alias("chunk")).agg(F.collect_list("row").alias("rows"))

    def leaf(r: dict) -> dict:
        again = {x["at"] for x in r["rows"] if x["initial"] is None}
        ordered = sorted((x for x in r["rows"] if x["initial"] is not None), key=lambda x: x["at"])
        part = folded((x["turn"], x["initial"], "duplicate" if x["at"] in again and x["fault"] != "blank" else x["fault"]) for x in ordered)
        return {x: r[x] for x in ("conv", "conv_id", "chunk")} | _flat(part)

    return keep(_mapped(chunks, _PLACE + _PART, leaf), "parts")


def reduced(parts: DataFrame) -> DataFrame:
    """One part a conversation, by a tree: each step joins up to 2**FAN_BITS neighbouring parts."""

    def join(r: dict) -> dict:
        return {x: r[x] for x in ("conv", "conv_id", "chunk")} | _flat(reduce(joined, map(_part, sorted(r["parts"], key=lambda x: x["at"]))))

    done, fields = [], [*_NUMBERS, "first", "last", "costs", "audits"]
    while True:
        many = keep(parts.groupBy("conv").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "several")
        if many.isEmpty():
            return reduce(DataFrame.unionByName, [*done, parts])
        small = broadcast_up_to(many, BROADCAST_CONVERSATIONS)
        done.append(parts.join(small, "conv", "left_anti"))
        group = F.when(F.col("n") > 1 << FAN_BITS, F.shiftright("chunk", FAN_BITS)).otherwise(0)  # chunks of a conversation are neighbours
        rows = parts.join(small, "conv").groupBy("conv", "conv_id", group.alias("chunk")).agg(F.collect_list(F.struct(F.col("chunk").alias("at"), *fields)).alias("parts"))
        parts = keep(_mapped(rows, _PLACE + _PART, join), "parts")


def _result(r: dict) -> dict:
    part = _part(r)
    ways = closed(part.matrix[START])
    cost, audit = _least([ways[START], ways[DONE]])
    gaps = 0 if part.low is None else part.high - part.low + 1 - part.turns
    return {"conv": r["conv"], "gaps": gaps, "blank": part.blank, "duplicate": part.duplicate, "truncated": part.truncated, "illegal": part.illegal, "cost": cost, "audit": audit}


def replayed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, str | None, str | None]]:
    """conv, role, text of the repaired turns from rows in order: of each conversation its audit (at is null), then its turns. A conversation begins with a pair of None."""
    conv, audit, at, state = None, "", 0, START

    def inserts() -> Iterator[tuple[str, str, str]]:
        nonlocal at, state
        while at < len(audit) and audit[at] == "I":
            at, state = at + 1, _NEXT[state]
            yield conv, _ROLE[state], ""

    for batch in batches:
        for r in range(batch.num_rows):
            row = {c: batch.column(c)[r].as_py() for c in ("conv", "at", "audit", "role", "text")}
            if row["at"] is None:
                conv, audit, at, state = row["conv"], row["audit"], 0, START
                yield conv, None, None
                yield from inserts()
                continue
            edit, at = audit[at], at + 1
            if edit != "D":
                state = _NEXT[state] if edit == "R" else _KEPT[row["role"][:1]][state]
                yield conv, _ROLE[state] if edit == "R" else row["role"], row["text"]
            yield from inserts()


class Repair(NamedTuple):
    """summary: conv, gaps, blank, duplicate, truncated, illegal, cost, audit of each conversation with turns. turns: their turns in order."""

    summary: DataFrame
    turns: DataFrame

    def _in_order(self) -> DataFrame:
        nothing = F.lit(None).cast("string")
        audits = self.summary.select("conv", F.lit(None).cast("long").alias("at"), "audit", nothing.alias("role"), nothing.alias("text"))
        rows = audits.unionByName(self.turns.select("conv", "at", nothing.alias("audit"), "role", "text"))
        return rows.repartition("conv").sortWithinPartitions("conv", F.asc_nulls_first("at"))

    def repaired(self) -> DataFrame:
        """conv, place (1, 2 ...), role, text of the repaired turns."""

        def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held, place = [], 0
            for conv, role, text in replayed(batches):
                place = 0 if role is None else place + 1
                held += [(conv, place, role, text)] if place else []
                if len(held) == 1000:
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*held, strict=True)], ["conv", "place", "role", "text"])
                    held = []
            if held:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*held, strict=True)], ["conv", "place", "role", "text"])

        return self._in_order().mapInArrow(rows, "conv string, place long, role string, text string")

    def digests(self) -> DataFrame:
        """conv, repaired_sha256 of `role:text` lines."""

        def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            conv, digest, some = None, None, False
            for now, role, text in replayed(batches):
                if role is None:
                    if digest is not None:
                        yield pa.RecordBatch.from_arrays([pa.array([conv]), pa.array([digest.hexdigest()])], ["conv", "repaired_sha256"])
                    conv, digest, some = now, hashlib.sha256(), False
                else:
                    digest.update(f"{chr(10) * some}{role}:{text}".encode())
                    some = True
            if digest is not None:
                yield pa.RecordBatch.from_arrays([pa.array([conv]), pa.array([digest.hexdigest()])], ["conv", "repaired_sha256"])

        return self._in_order().mapInArrow(rows, "conv string, repaired_sha256 string")


def conv_key(conv_id: str = "conv_id") -> Column:
    """A conversation's id as text that is never null."""
    return F.concat(F.when(F.col(conv_id).isNull(), "-").otherwise("+"), F.coalesce(F.col(conv_id).cast("string"), F.lit("")))


def repair(conversations: DataFrame) -> Repair:
    """Faults and the cheapest edits of conversations (conv_id, turn, role, text); other columns are ignored.

    Turns are taken by turn (nulls first), role and text; equal rows follow each
    other. Null roles and texts are one space. Rows without a conv_id are one
    conversation. A role of another initial than s, u or a can only be changed
    or deleted. An empty table has no conversations.
    """
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    rows = conversations.select(conv_key().alias("conv"), F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), space("role"), space("text"))
    turns = ordinals(rows, F.asc("conv"), F.asc_nulls_first("turn"), F.asc("role"), F.asc("text"), name="at")
    turns = turns.withColumn("at", F.col("at") - 1)
    summary = _mapped(reduced(leaves(turns)), "conv string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string", _result)
    return Repair(keep(summary, "repairs"), turns)


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text with every twentieth row, by a hash of id and turn, dropped, emptied, cut, repeated or given to the user. Nulls are one space, but ids and turns stay."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    k = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn"))) % 20
    rows = conversations.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"), k.alias("__k")).where("__k <> 0")
    changed = F.when(F.col("__k") == 1, "").when(F.col("__k") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("__k") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.array_repeat(F.lit(0), F.when(F.col("__k") == 3, 2).otherwise(1)))
    return rows.select("conv_id", "turn", role.alias("role"), changed.alias("text"), copies.alias("__copy")).drop("__copy")


def repair_report(conversations: DataFrame) -> DataFrame:
    """The result of repairing damaged conversations, a row for each conv_id of the input, also where no row is left."""
    found = repair(damaged(conversations))
    ids = conversations.select("conv_id").distinct().withColumn("conv", conv_key())
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    empty = hashlib.sha256().hexdigest()
    texts = [F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(empty)).alias("repaired_sha256")]
    return ids.join(found.summary, "conv", "left").join(found.digests(), "conv", "left").select("conv_id", *counts, *texts)


def _sql_way(*ways: str) -> str:
    return f"list_min([{', '.join(ways)}])"


def _sql_more(way: str, cost: str, edit: str, line: str = "''") -> str:
    return f"{{c: {way}.c + {cost}, a: {way}.a || '{edit}', t: {way}.t || {line}}}"


def _oracle() -> str:
    user, assistant = "chr(10) || 'user:'", "chr(10) || 'assistant:'"
    most = "{c: 1000000000, a: '', t: ''}"
    closure = lambda v: (
        f"SELECT *, {_sql_way('v3', _sql_more('u2', '3', 'I', assistant))} AS u3 FROM "
        f"(SELECT *, {_sql_way('v2', *(_sql_more(x, '3', 'I', user) for x in ('v0', 'v1', 'v3')))} AS u2 FROM {v})"
    )
    keeps = lambda initial, way: f"CASE WHEN ok AND i = '{initial}' THEN {_sql_more(way, 'cut', 'K', 'line')} ELSE {most} END"
    roles = lambda way, line: f"CASE WHEN ok THEN {_sql_more(way, '3 + cut', 'R', f'{line} || body')} ELSE {most} END"
    gone = lambda way: _sql_more(way, "4", "D")
    to_user = [f(x) for x in ("v0", "v1", "u3") for f in (lambda w: keeps("u", w), lambda w: roles(w, user))]
    return rf"""
WITH RECURSIVE tab AS (SELECT list_transform(range(256), lambda n: list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, n)) AS t),
base AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS body, hex(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')) AS x FROM conversations),
hashed AS (SELECT *, xor(list_reduce(list_transform(range(1, length(x), 2), lambda i: ('0x' || substr(x, i::INT, 2))::BIGINT), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295::BIGINT), 4294967295) % 20 AS k FROM base, tab),
harmed AS (SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role, CASE k WHEN 1 THEN '' WHEN 2 THEN regexp_replace(body, '[.!?]', '', 'g') ELSE body END AS body, unnest(range(CASE WHEN k = 3 THEN 2 ELSE 1 END)) AS copy FROM hashed WHERE k <> 0),
numbered AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, body, copy) AS n FROM harmed),
again AS (SELECT *, left(role, 1) AS i, row_number() OVER (PARTITION BY conv_id, role, body ORDER BY n) > 1 AS again, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY n) || left(role, 1) AS pair FROM numbered),
turns AS MATERIALIZED (SELECT *, CASE WHEN NOT regexp_matches(body, '[^\x20\x09-\x0D]') THEN 'b' WHEN again THEN 'd' WHEN NOT regexp_matches(body, '[.!?][\x20\x09-\x0D]*\z') THEN 't' ELSE '' END AS fault FROM again),
steps AS MATERIALIZED (SELECT conv_id, n, i, fault NOT IN ('b', 'd') AS ok, CASE WHEN fault = 't' THEN 3 ELSE 0 END AS cut, chr(10) || role || ':' || body AS line, body FROM turns),
walk AS (
  SELECT conv_id, 0::BIGINT AS n, {{c: 0, a: '', t: ''}} AS v0, {most} AS v1, {most} AS v2, {most} AS v3 FROM (SELECT DISTINCT conv_id FROM steps)
  UNION ALL
  SELECT conv_id, n, {gone("v0")}, {_sql_way(gone("v1"), keeps("s", "v0"))}, {_sql_way(gone("u2"), *to_user)}, {_sql_way(gone("u3"), keeps("a", "u2"), roles("u2", assistant))}
  FROM ({closure("(SELECT s.*, v0, v1, v2, v3 FROM walk w JOIN steps s ON w.conv_id IS NOT DISTINCT FROM s.conv_id AND s.n = w.n + 1)")})
),
last_step AS (SELECT conv_id, max(n) AS n FROM steps GROUP BY conv_id),
ended AS (SELECT conv_id, {_sql_way("v0", "u3")} AS best FROM ({closure("(SELECT w.* FROM walk w JOIN last_step l ON w.conv_id IS NOT DISTINCT FROM l.conv_id AND w.n = l.n)")})),
counted AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count_if(fault = 'b') AS blank, count_if(fault = 'd') AS duplicate, count_if(fault = 't') AS truncated, count_if(pair NOT IN ('su', 'ua', 'au')) AS illegal FROM turns GROUP BY conv_id)
SELECT d.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
  coalesce(illegal, 0)::BIGINT AS illegal, coalesce(best.c, 0)::BIGINT AS cost, coalesce(best.a, '') AS audit, sha256(coalesce(substr(best.t, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) d LEFT JOIN counted c ON d.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN ended e ON d.conv_id IS NOT DISTINCT FROM e.conv_id
"""


ORACLE = _oracle()
