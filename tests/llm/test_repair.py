"""Repair of conversations: the lattice search against all edit sequences, whole tables against plain Python."""

import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from gridmart.llm import repair

GOOD = re.compile(r"(s?(ua)+)?")
SPACES = " \t\n\x0b\x0c\r"


def by_trial(rows, most=9):
    """Least cost and audit among all strings of edits, roles chosen freely."""
    best = None
    for n in range(most + 1):
        for audit in itertools.product("DIKR", repeat=n):
            if sum(c != "I" for c in audit) != len(rows):
                continue
            options, cost, at = [""], 0, 0
            for c in audit:
                if c == "I":
                    cost += 2
                    options = [o + r for o in options for r in "ua"]
                    continue
                initial, fault = rows[at]
                at += 1
                if c == "D":
                    cost += 3
                    continue
                if fault in ("blank", "duplicate"):
                    options = []
                cost += (2 if c == "R" else 0) + (fault == "truncated")
                options = [o + r for o in options for r in ("ua" if c == "R" else [initial or "-"])]
            if any(GOOD.fullmatch(o) for o in options):
                best = min(best or (10**9, ""), (cost, "".join(audit)))
    return best


def test_search_finds_the_least_of_all_edits():
    rng = random.Random(3)
    for _ in range(60):
        rows = [
            (rng.choice(["u", "a", "s", "x", ""]), rng.choice([None, None, "truncated", "blank", "duplicate"]))
            for _ in range(rng.randrange(4))
        ]
        # An optimal string has no two insertions more than rows, but for a pair of its own.
        assert repair.cheapest(rows, 0, (0, 3)) == by_trial(rows, len(rows) * 2 + 1), rows


def plain(rows):
    """Least cost and audit, and the repaired rows, by a table over rows and states."""
    step = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
    need = {0: "user", 1: "user", 2: "assistant", 3: "user"}

    def inserted(labels):
        for _ in range(2):
            for s, (cost, audit, out) in list(labels.items()):
                t = step[s, need[s][0]]
                new = (cost + 2, audit + "I", [*out, need[s] + ":"])
                if t not in labels or new[:2] < labels[t][:2]:
                    labels[t] = new
        return labels

    labels = inserted({0: (0, "", [])})
    for role, text, fault in rows:
        new = {}

        def put(state, label):
            if state not in new or label[:2] < new[state][:2]:
                new[state] = label

        for s, (cost, audit, out) in labels.items():
            put(s, (cost + 3, audit + "D", out))
            if fault not in ("blank", "duplicate"):
                more = fault == "truncated"
                put(step[s, need[s][0]], (cost + 2 + more, audit + "R", [*out, need[s] + ":" + text]))
                if (s, role[:1]) in step:
                    put(step[s, role[:1]], (cost + more, audit + "K", [*out, role + ":" + text]))
        labels = inserted(new)
    return min((labels[s] for s in (0, 3) if s in labels), key=lambda x: x[:2])


def expected(messages):
    """Every column of the query, in plain Python."""
    found = {}
    for conv, turn, role, text in messages:
        kept = found.setdefault(conv, [])
        shown = [" " if v is None else v for v in (conv, turn, role, text)]
        role, text = shown[2:]
        kind = zlib.crc32(f"{shown[0]}:{shown[1]}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        kept += [(turn, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
    result = {}
    for conv, rows in found.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, faults = set(), []
        for _, role, text in rows:
            end = text.strip(SPACES)[-1:]
            fault = "blank" if not end else "duplicate" if (role, text) in seen else None
            faults.append(fault or (None if end in (".", "!", "?") else "truncated"))
            seen.add((role, text))
        turns = {t for t, _, _ in rows if t is not None}
        cost, audit, out = plain([(r, x, f) for (_, r, x), f in zip(rows, faults, strict=True)])
        result[conv] = (
            max(turns) - min(turns) + 1 - len(turns) if turns else 0,
            *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:])),
            cost,
            audit,
            hashlib.sha256("\n".join(out).encode()).hexdigest(),
        )
    return result


COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def run(spark, messages, size=repair.BLOCK, parts=3):
    schema = "conv_id bigint, turn int, role string, text string, part string, `a.b` string, said string"
    df = spark.createDataFrame([(*m, "p", "q", "r") for m in messages], schema).repartition(parts)
    harmed = repair.damage(df)
    audits, repaired = repair.repair(repair.blocks(harmed, size))
    rows = repair.digest(harmed, audits, repaired, df).collect()
    assert len(rows) == len({r.conv_id for r in rows})
    return {r.conv_id: tuple(r[c] for c in COLUMNS) for r in rows}


def talk(rng, conv, n, first=0):
    roles = ["user", "assistant", "system", "tool", "", None, "user", "assistant"]
    texts = ["Yes.", "no", " \t", "", None, "Why?", "é!", "x" * 300, "Yes. \n"]
    odd = rng.random() < 0.4
    for i in range(n):
        role = rng.choice(roles) if odd else ("user", "assistant")[i % 2]
        yield conv, rng.choice([i, None]) if odd and rng.random() < 0.2 else first + i, role, rng.choice(texts) if odd else f"t {i}."


@pytest.mark.parametrize("size", [1, 3, repair.BLOCK])
def test_whole_tables_against_plain_python(spark, size):
    rng = random.Random(size)
    messages = [m for c in range(25) for m in talk(rng, c, rng.randrange(1, 12))]
    messages += list(talk(rng, 900, 240)) + [(901, t, "user", "same?") for t in range(200)]
    messages += [(902, 1, "user", "again."), (902, 1, "user", "again."), (902, 1, "assistant", "again.")]
    messages += [(903, None, None, None), (903, None, "user", "y" * 40_000), (None, 1, "user", "z."), (None, 2, None, "z")]
    assert run(spark, messages, size) == expected(messages)


def test_a_conversation_without_rows_left(spark):
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert run(spark, [(gone, 0, "user", "hello.")]) == {gone: nothing}
    assert run(spark, []) == {}


def test_a_long_conversation_lies_in_blocks_of_several_tasks(spark):
    messages = spark.range(5000).select(
        F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.lit("user").alias("role"), F.concat(F.lit("t"), "id").alias("text")
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = repair.blocks(messages)
        sizes = found.agg(F.max(F.size("messages")), F.count_distinct("part"), F.sum(F.size("messages"))).first()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sizes[0] <= repair.BLOCK and sizes[1] > 3 and sizes[2] == 5000
    audits, repaired = repair.repair(found)
    row = audits.first()
    assert audits.count() == 1 and row.illegal == 4999 and row.truncated == 5000 and row.cost == 10_000
    out = [m for r in repaired.orderBy("part", "block").collect() for m in r.messages]
    assert len(out) == 5000 + row.audit.count("I") and [m.role for m in out[:4]] == ["user", "assistant"] * 2
