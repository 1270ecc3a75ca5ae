"""Repair of conversations by shortest paths through a lattice of edits.

A node of the lattice says how many turns are used up and in which state the conversation is: nothing said,
after a system turn, after a user turn, after an assistant turn. Arcs are edits: Keep a turn that fits (0),
Rerole it to the role that fits (1), Delete it (2), Insert an empty turn of the role that fits (5). Blank turns
and duplicates can only be deleted; an undeleted truncated turn costs 5 more. The conversation ends in the
first or the last state, so its roles read ``(s?(ua)+)?``.

Prices are found by the auction algorithm for shortest paths. A path grows from its origin along the
arc that is cheapest by cost plus price (extension); where the price of its last node is below that, the
price rises and the path gives the node up (contraction). It ends at a node whose price is settled, and
then all of its nodes are. Every node is an origin, layer by layer from the end, so all prices converge
to distances. Arcs whose cost is the difference of their prices are tight, every way along tight arcs is a
cheapest one, and taking the least letter at each node gives the least audit.

No conversation is held whole. The turns are dealt into ranges of their order and cut into fragments of at
most ``FRAGMENT`` turns. A fragment becomes four by four distances between the states at its ends; the
distances of a conversation's fragments, a few numbers each, are combined from its end to prices behind
every fragment; with these each fragment is traced from every state by itself, and a last pass over
the fragments picks the traces that meet. ``digests`` alone reads a conversation as one stream, as SHA-256
needs it, without holding it.

Defined results: a null role or text is one space; null turns come first; turns with equal numbers go by
role, then text; all rows with a null key are one conversation; an empty table gives empty results. Other
columns of any name do no harm.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tablecraft.sources import stage

FRAGMENT = 4096  # turns
WHITE = " \t\n\x0b\x0c\r"
NO_WAY = 1 << 60

KEEP, REROLE, DELETE, INSERT = ("K", 0), ("R", 1), ("D", 2), ("I", 5)
TRUNCATED_COST = 5
FOLLOWS = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})  # state -> initial -> next state
FITTING = ("user", "user", "assistant", "user")  # the role that Rerole and Insert give in a state
ENDING = ("", "II", "I", "")  # what completes a conversation
CLOSING = tuple(len(x) * INSERT[1] for x in ENDING)
LEGAL = {"su", "ua", "au"}
# One letter a turn: its initial; small if the turn is sound, capital if truncated, a digit if it has to go.
INITIALS = "suax"
MARKS = {"sound": "suax", "truncated": "SUAX", "gone": "0123"}


def _arcs(mark: str) -> list[list[tuple[str, int, bool, int]]]:
    """For each state: letter, cost, whether a turn is used up, next state; by letter."""
    kind = next(k for k, marks in MARKS.items() if mark in marks)
    initial = INITIALS[MARKS[kind].index(mark)]
    more = TRUNCATED_COST if kind == "truncated" else 0
    made = []
    for state in range(4):
        fitting = FOLLOWS[state][FITTING[state][0]]
        arcs = [(*DELETE, True, state), (*INSERT, False, fitting)]
        if kind != "gone":
            if initial in FOLLOWS[state]:
                arcs.append((KEEP[0], KEEP[1] + more, True, FOLLOWS[state][initial]))
            arcs.append((REROLE[0], REROLE[1] + more, True, fitting))
        made.append(sorted(arcs))
    return made


ARCS = {mark: _arcs(mark) for marks in MARKS.values() for mark in marks}


def prices(marks: str, behind: tuple[int, ...]) -> list[list[int]]:
    """Converged prices of all nodes before each turn and, last, ``behind`` the last turn."""
    price: list[list[int]] = [[]] * len(marks) + [list(behind)]
    for i in range(len(marks) - 1, -1, -1):
        arcs, after = ARCS[marks[i]], price[i + 1]
        here = [min(after)] * 4  # no price is above the cost and price of any arc
        beyond = max(p for p in after if p < NO_WAY) + 4 * sum(cost for _, cost in (KEEP, REROLE, DELETE, INSERT)) + TRUNCATED_COST
        settled = [False] * 4
        for origin in range(4):
            path = [origin]
            while not settled[origin]:
                node = path[-1]
                best, used, to = min((cost + (after if used else here)[to], not used, to) for _, cost, used, to in arcs[node])
                if best > beyond:  # above any finite distance: there is no way
                    here[node], settled[node] = NO_WAY, True
                    path = path[:-1] or path
                elif here[node] < best:
                    here[node] = best
                    path = path[:-1] or path
                elif not used or settled[to]:
                    for reached in path:
                        settled[reached] = True
                else:
                    path.append(to)
        price[i] = here
    return price


@lru_cache(50_000)
def distances(marks: str) -> tuple[tuple[int, ...], ...]:
    """Cheapest ways through a fragment, from each state before it to each state behind it."""
    to_state = [prices(marks, tuple(0 if s == end else NO_WAY for s in range(4)))[0] for end in range(4)]
    return tuple(tuple(min(NO_WAY, to_state[end][start]) for end in range(4)) for start in range(4))


@lru_cache(50_000)
def traces(marks: str, behind: tuple[int, ...]) -> tuple[tuple[str, int], ...]:
    """The least audit of a fragment and the state behind it, from each state before it."""
    price = prices(marks, behind)
    made = []
    for state in range(4):
        letters, i = [], 0
        while i < len(marks):
            letter, used, state = next(
                (x, used, to) for x, cost, used, to in ARCS[marks[i]][state] if price[i][state] == cost + price[i + used][to]
            )
            letters.append(letter)
            i += used
        made.append(("".join(letters), state))
    return tuple(made)


def damage(turns: DataFrame, *, key: str, turn: str, role: str, text: str) -> DataFrame:
    """Trial faults by the unsigned crc32 of ``key:turn`` modulo 20 (nulls: one space): 0 drops the turn,
    1 empties its text, 2 removes its ``[.!?]``, 3 repeats it, 4 makes it a user turn."""
    named = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (key, turn)]
    rows = turns.select(
        F.col(key).alias("key"),
        F.col(turn).alias("turn"),
        *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(n) for c, n in ((role, "role"), (text, "text"))],
        (F.crc32(F.concat_ws(":", *named).cast("binary")) % 20).alias("draw"),
    )
    return rows.where("draw <> 0").select(
        "key",
        "turn",
        F.when(F.col("draw") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("draw") == 1, F.lit("")).when(F.col("draw") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("draw") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"),
    ).drop("copy")


def _in_fragments(kind: pa.DataType):
    """Numbers the fragments of a task and the turns in them; a turn like the one before it is a duplicate."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, fragment, place = None, -1, 0
        for batch in batches:
            part, key, turn, digest, fault = (batch.column(c).to_pylist() for c in ("part", "key", "turn", "digest", "fault"))
            fragments, places, faults = [], [], []
            for i in range(batch.num_rows):
                if last is None or key[i] != last[0] or place == FRAGMENT:
                    fragment, place = fragment + 1, 0
                row = (key[i], turn[i], digest[i])
                faults.append("duplicate" if row == last and fault[i] != "blank" else fault[i])
                fragments.append((part[i] << 40) + fragment)
                places.append(place)
                last, place = row, place + 1
            columns = [batch.column(c) for c in ("key", "turn", "role", "text")]
            columns += [pa.array(fragments, pa.int64()), pa.array(places, pa.int32()), pa.array(faults, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "turn", "role", "text", "fragment", "place", "fault"])

    return run


def with_faults(turns: DataFrame, *, key: str = "key", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The turns in their order: key, fragment, place in it, turn, role, text, and the first ``fault`` of
    blank, duplicate (role and text were said before), truncated (no ``[.!?]`` at the end)."""
    role_text, said = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (role, text))
    trimmed = F.rtrim(F.col("text"), F.lit(WHITE))
    rows = (
        turns.select(F.col(key).alias("key"), F.col(turn).alias("turn"), role_text.alias("role"), said.alias("text"))
        .withColumn("digest", F.sha2(F.concat(F.char_length("role").cast("string"), F.lit(":"), "role", "text"), 256))
        .withColumn("at", F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn")))
    )
    said_again = (
        rows.groupBy("key", "digest")
        .agg(F.min("at").alias("first"), F.max("at").alias("last"))
        .where("first <> last")
        .select(F.col("key").alias("said_key"), F.col("digest").alias("said_digest"), "first")
    )
    told = rows.join(said_again, F.col("key").eqNullSafe(F.col("said_key")) & (F.col("digest") == F.col("said_digest")), "left")
    fault = (
        F.when(trimmed == "", "blank")
        .when(F.col("first").isNotNull() & (F.col("at") > F.col("first")), "duplicate")
        .when(~F.right(trimmed, F.lit(1)).isin(".", "!", "?"), "truncated")
    )
    told = told.select("key", "turn", "role", "text", "digest", fault.alias("fault"))
    dealt = told.repartitionByRange("key", F.asc_nulls_first("turn"), "role", F.substring("text", 1, 32))
    dealt = dealt.sortWithinPartitions("key", F.asc_nulls_first("turn"), "role", "text").withColumn("part", F.spark_partition_id().cast("long"))
    kinds = f"key {rows.schema['key'].dataType.simpleString()}, turn {rows.schema['turn'].dataType.simpleString()}"
    numbered = dealt.mapInArrow(
        _in_fragments(to_arrow_type(rows.schema["key"].dataType)), f"{kinds}, role string, text string, fragment long, place int, fault string"
    )
    return stage(numbered, "repair-turns")


def _mark() -> Column:
    """The letter of a turn, from its initial and its fault."""
    initial = F.left("role", F.lit(1))
    known = F.when(initial.isin(*INITIALS[:3]), initial).otherwise(INITIALS[3])
    gone = F.translate(known, INITIALS, MARKS["gone"])
    return F.when(F.col("fault").isin("blank", "duplicate"), gone).when(F.col("fault") == "truncated", F.upper(known)).otherwise(known)


def _initial(mark: str) -> str:
    return next(INITIALS[marks.index(mark)] for marks in MARKS.values() if mark in marks)


def _illegal(marks: str) -> int:
    initials = "".join(map(_initial, marks))
    return sum(initials[i : i + 2] not in LEGAL for i in range(len(initials) - 1))


def _by_rows(made: Callable[[Iterator[dict]], Iterator[dict]], schema: pa.Schema, most: int = 5000):
    """A function of batches from a function of rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for row in made(r for batch in batches for r in batch.to_pylist()):
            held.append(row)
            if len(held) >= most:
                yield pa.RecordBatch.from_pylist(held, schema)
                held = []
        if held:
            yield pa.RecordBatch.from_pylist(held, schema)

    return run


def _measured(rows: Iterator[dict]) -> Iterator[dict]:
    for r in rows:
        ways = [d for line in distances(r["marks"]) for d in line]
        yield {"key": r["key"], "fragment": r["fragment"], "marks": r["marks"], "ways": ways, "illegal": _illegal(r["marks"])}


def _priced(rows: Iterator[dict]) -> Iterator[dict]:
    """From the last fragment of each conversation to the first: the prices behind each."""
    behind, seen = CLOSING, None
    for r in rows:
        last = seen is None or seen["key"] != r["key"]
        if last:
            behind = CLOSING
        ways = r.pop("ways")
        seen = r
        before = tuple(min(ways[4 * s + e] + behind[e] for e in range(4)) for s in range(4))
        yield r | {"behind": list(behind), "cost": before[0], "last": last}
        behind = before


def _traced(rows: Iterator[dict]) -> Iterator[dict]:
    for r in rows:
        found = traces(r["marks"], tuple(r.pop("behind")))
        yield r | {"audits": [a for a, _ in found], "exits": [e for _, e in found]}


def _picked(rows: Iterator[dict]) -> Iterator[dict]:
    """From the first fragment to the last: the trace from the state that the one before it ends in."""
    seen, state = None, 0
    for r in rows:
        first = seen is None or seen["key"] != r["key"]
        if first:
            state = 0
        between = 0 if first else int(_initial(seen["marks"][-1]) + _initial(r["marks"][0]) not in LEGAL)
        after = r["exits"][state]
        yield {
            "key": r["key"],
            "fragment": r["fragment"],
            "state": state,
            "audit": r["audits"][state] + (ENDING[after] if r["last"] else ""),
            "illegal": r["illegal"] + between,
            "cost": r["cost"] if first else 0,
        }
        seen, state = r, after


def _spelled(rows: Iterator[dict]) -> Iterator[dict]:
    """One row per edit, with the place of the turn it uses and the role it gives."""
    for r in rows:
        state, place = r["state"], 0
        for step, letter in enumerate(r["audit"]):
            role = FITTING[state] if letter in "RI" else None
            yield {"key": r["key"], "fragment": r["fragment"], "step": step, "edit": letter, "place": None if letter == "I" else place, "new_role": role}
            if letter in "RI":
                state = FOLLOWS[state][role[0]]
            elif letter == "K":
                state = FOLLOWS[state][_initial(r["marks"][place])]
            place += letter != "I"


def _schema(kind: pa.DataType, **fields: pa.DataType) -> pa.Schema:
    return pa.schema([("key", kind), ("fragment", pa.int64()), *fields.items()])


@dataclass
class Repaired:
    """``faults``: the turns with their faults. ``audits``: one row per fragment, its edits as letters, its
    cost (all of it at the first fragment) and illegal steps. ``turns``: the repaired conversations."""

    faults: DataFrame
    audits: DataFrame
    turns: DataFrame


def repair(turns: DataFrame, **names: str) -> Repaired:
    """The cheapest repair of every conversation; of equally cheap ones that whose letters come first."""
    rows = with_faults(turns, **names)
    key = rows.schema["key"].dataType
    kind, name = to_arrow_type(key), key.simpleString()
    codes = F.array_sort(F.collect_list(F.struct("place", _mark().alias("mark"))))
    fragments = rows.groupBy("key", "fragment").agg(F.array_join(F.transform(codes, lambda x: x["mark"]), "").alias("marks"))

    ints, text = pa.list_(pa.int64()), pa.string()
    measured = fragments.mapInArrow(
        _by_rows(_measured, _schema(kind, marks=text, ways=ints, illegal=pa.int64())),
        f"key {name}, fragment long, marks string, ways array<long>, illegal long",
    )
    backward = measured.repartition("key").sortWithinPartitions("key", F.desc("fragment"))
    priced = backward.mapInArrow(
        _by_rows(_priced, _schema(kind, marks=text, illegal=pa.int64(), behind=ints, cost=pa.int64(), last=pa.bool_())),
        f"key {name}, fragment long, marks string, illegal long, behind array<long>, cost long, last boolean",
    )
    traced = priced.repartition("fragment").mapInArrow(
        _by_rows(
            _traced, _schema(kind, marks=text, illegal=pa.int64(), cost=pa.int64(), last=pa.bool_(), audits=pa.list_(text), exits=ints), 500
        ),
        f"key {name}, fragment long, marks string, illegal long, cost long, last boolean, audits array<string>, exits array<long>",
    )
    forward = traced.repartition("key").sortWithinPartitions("key", "fragment")
    audits = stage(
        forward.mapInArrow(
            _by_rows(_picked, _schema(kind, state=pa.int32(), audit=text, illegal=pa.int64(), cost=pa.int64())),
            f"key {name}, fragment long, state int, audit string, illegal long, cost long",
        ),
        "repair-audits",
    )
    edits = (
        audits.join(fragments.select(F.col("fragment").alias("of"), "marks"), F.col("fragment") == F.col("of"))
        .select("key", "fragment", "state", "audit", "marks")
        .mapInArrow(
            _by_rows(_spelled, _schema(kind, step=pa.int32(), edit=text, place=pa.int32(), new_role=text)),
            f"key {name}, fragment long, step int, edit string, place int, new_role string",
        )
    )
    given = rows.select(F.col("fragment").alias("of"), F.col("place").alias("at"), "turn", "role", "text")
    repaired = edits.where("edit <> 'D'").join(given, (F.col("fragment") == F.col("of")) & (F.col("place") == F.col("at")), "left")
    repaired = repaired.select(
        "key", "fragment", "step", "edit", "turn", F.coalesce("new_role", "role").alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    return Repaired(rows, audits, repaired)


def _hashed(rows: Iterator[dict]) -> Iterator[dict]:
    key, digest = None, None
    for r in rows:
        said = f"{r['role']}:{r['text']}".encode("utf-8", "surrogatepass")
        if digest is None or r["key"] != key:
            if digest is not None:
                yield {"key": key, "repaired_sha256": digest.hexdigest()}
            key, digest = r["key"], hashlib.sha256(said)
        else:
            digest.update(b"\n" + said)
    if digest is not None:
        yield {"key": key, "repaired_sha256": digest.hexdigest()}


def digests(turns: DataFrame) -> DataFrame:
    """``(key, repaired_sha256)`` of conversations that have turns: ``role:text``, joined by line breaks."""
    key = turns.schema["key"].dataType
    in_order = turns.repartition("key").sortWithinPartitions("key", "fragment", "step").select("key", "role", "text")
    schema = pa.schema([("key", to_arrow_type(key)), ("repaired_sha256", pa.string())])
    return in_order.mapInArrow(_by_rows(_hashed, schema), f"key {key.simpleString()}, repaired_sha256 string")


def report(keys: DataFrame, repaired: Repaired) -> DataFrame:
    """One row per key of ``keys`` (column ``key``): gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256. A key without turns gets zeros, an empty audit and the digest of the empty text."""
    faults = ["blank", "duplicate", "truncated"]
    by_turn = repaired.faults.groupBy("key", "turn").agg(*[F.count_if(F.col("fault") == f).alias(f) for f in faults])
    counts = by_turn.groupBy("key").agg(
        (F.max("turn") - F.min("turn") + 1 - F.count("turn")).alias("gaps"), *[F.sum(f).alias(f) for f in faults]
    )
    pieces = F.array_sort(F.collect_list(F.struct("fragment", "audit")))
    edits = repaired.audits.groupBy("key").agg(
        F.sum("illegal").alias("illegal"),
        F.sum("cost").alias("cost"),
        F.array_join(F.transform(pieces, lambda x: x["audit"]), "").alias("audit"),
    )
    made = keys.select("key").distinct()
    for part in (counts, edits, digests(repaired.turns)):
        part = part.withColumnRenamed("key", "part_key")
        made = made.join(part, F.col("key").eqNullSafe(F.col("part_key")), "left").drop("part_key")
    numbers = ["gaps", *faults, "illegal", "cost"]
    return made.select(
        "key",
        *[F.coalesce(F.col(n), F.lit(0)).cast("long").alias(n) for n in numbers],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )
