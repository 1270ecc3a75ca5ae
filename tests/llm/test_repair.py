"""Repair of conversations against brute force."""

import hashlib
import heapq
import random
import re
import zlib

import pytest

from tablecraft.llm import repair
from tablecraft.llm.queries import QUERIES

SAYS = re.compile("[^\\x20\\x09-\\x0D]")


def damaged(rows):
    made = []
    for key, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        draw = zlib.crc32(f"{' ' if key is None else key}:{' ' if turn is None else turn}".encode()) % 20
        if draw == 1:
            text = ""
        if draw == 2:
            text = re.sub("[.!?]", "", text)
        if draw == 4:
            role = "user"
        made += [(key, turn, role, text)] * (0 if draw == 0 else 2 if draw == 3 else 1)
    return made


def cheapest(turns):
    """Least (cost, letters) by Dijkstra over whole strings; turns are (role, text, fault)."""
    follows = {"": "su", "s": "u", "u": "a", "a": "u"}
    heap = [(0, "", 0, "", ())]
    seen = set()
    while heap:
        cost, letters, i, state, made = heapq.heappop(heap)
        if i == len(turns) and state in ("", "a"):
            return cost, letters, made
        if (i, state) in seen:
            continue
        seen.add((i, state))
        for role in ("user", "assistant"):
            if role[0] in follows[state]:
                heapq.heappush(heap, (cost + 5, letters + "I", i, role[0], (*made, (role, ""))))
        if i < len(turns):
            role, text, fault = turns[i]
            heapq.heappush(heap, (cost + 2, letters + "D", i + 1, state, made))
            if fault not in ("blank", "duplicate"):
                more = 5 if fault == "truncated" else 0
                if role[:1] and role[0] in follows[state]:
                    heapq.heappush(heap, (cost + more, letters + "K", i + 1, role[0], (*made, (role, text))))
                for other in ("user", "assistant"):
                    if other[0] in follows[state]:
                        heapq.heappush(heap, (cost + more + 1, letters + "R", i + 1, other[0], (*made, (other, text))))


def brute(original, rows):
    made = []
    for key in {r[0] for r in original}:
        mine = sorted(((t is not None, t or 0, role, text) for k, t, role, text in rows if k == key))
        seen, turns = set(), []
        for _, _, role, text in mine:
            said = SAYS.findall(text)
            fault = "blank" if not said else "duplicate" if (role, text) in seen else "truncated" if said[-1] not in ".!?" else None
            seen.add((role, text))
            turns.append((role, text, fault))
        known = [t for is_known, t, _, _ in mine if is_known]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        faults = [sum(t[2] == f for t in turns) for f in ("blank", "duplicate", "truncated")]
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:]))
        cost, letters, repaired = cheapest(turns)
        text = "\n".join(f"{r}:{t}" for r, t in repaired)
        made.append((key, gaps, *faults, illegal, cost, letters, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(made, key=repr)


def found(df, key="key"):
    names = [key, "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)


def made_up():
    rng = random.Random(4)
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", "s", None]
    texts = ["Yes.", "No!", "well", "", " \t", "Is it?", "a. \n", "b\x1c", "c.\x1c", None, "\x85", "é."]
    rows = []
    for key in [*range(60), None, -4]:
        n = rng.choice([1, 2, 3, 5, 8, 14])
        turns = sorted(rng.choice([None, -3, *range(20)]) or 0 for _ in range(n)) if key != 7 else [None] * n
        rows += [(key, t if rng.random() > 0.05 else None, rng.choice(roles), rng.choice(texts) if rng.random() < 0.5 else f"{rng.random()}.") for t in turns]
    return rows


KINDS = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("fragment", [repair.FRAGMENT, 2, 1])
def test_repairs_are_brute_force(spark, monkeypatch, fragment):
    """Fragments of one turn put every state between fragments to the test."""
    monkeypatch.setattr(repair, "FRAGMENT", fragment)
    rows = made_up()
    turns = spark.createDataFrame([(*r, "k", 1, 2, "x") for r in rows], f"{KINDS}, key string, fragment int, part int, digest string")
    for given, expected in (
        (repair.damage(turns, key="conv_id", turn="turn", role="role", text="text"), damaged(rows)),
        (turns.select("conv_id", "turn", "role", "text").toDF("key", "turn", "role", "text"), [(*r[:2], *[" " if x is None else x for x in r[2:]]) for r in rows]),
    ):
        keys = turns.select("conv_id").toDF("key")
        assert found(repair.report(keys, repair.repair(given))) == brute(rows, expected)


def test_prices_are_distances():
    rng = random.Random(1)
    for _ in range(300):
        marks = "".join(rng.choice("".join(repair.MARKS.values())) for _ in range(rng.randint(0, 9)))
        kinds = {m: k for k, ms in repair.MARKS.items() for m in ms}
        turns = [(repair._initial(m), "t", {"gone": "blank", "truncated": "truncated", "sound": None}[kinds[m]]) for m in marks]
        cost, letters, _ = cheapest(turns)
        assert repair.prices(marks, repair.CLOSING)[0][0] == cost
        audit, state = repair.traces(marks, repair.CLOSING)[0]
        assert audit + repair.ENDING[state] == letters
    ways = repair.distances("uu")
    assert ways[2][0] == ways[3][1] == repair.NO_WAY and ways[0] == (4, repair.NO_WAY, 2, 1)


def test_all_conversations(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert found(QUERIES["op11_repair"](spark, sf_dir), "conv_id") == brute(rows, damaged(rows))


def test_one_long_conversation(spark):
    """All turns under one key: fragments lie in many tasks and are as long as they may be."""
    n = 20_000
    rows = [(None, i, ("user", "assistant", "user")[i % 3], f"turn {i}" + ".!? "[i % 4]) for i in range(n)]
    turns = spark.createDataFrame(rows, "key long, turn long, role string, text string").repartition(8)
    made = repair.repair(turns)
    assert made.faults.groupBy("fragment").count().count() >= n // repair.FRAGMENT
    assert found(repair.report(turns, made)) == brute(rows, rows)


def test_no_turns(spark):
    empty = spark.createDataFrame([], "key string, turn int, role string, text string")
    assert found(repair.report(empty, repair.repair(empty))) == []
    keys = spark.createDataFrame([("a",)], "key string")
    nothing = hashlib.sha256(b"").hexdigest()
    assert found(repair.report(keys, repair.repair(empty))) == [("a", 0, 0, 0, 0, 0, 0, "", nothing)]
