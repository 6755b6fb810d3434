"""Conversation repair against all edits of small lattices, and against a table of costs for long ones."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from snapfold.llm import repair
from snapfold.llm.repair import Row

WHOLE = re.compile(r"(s?(ua)+)?\Z")


def brute(rows):
    """Least (cost, audit) by a full table over (rows read, what the roles so far are), audits kept whole."""
    layer = {"": (0, "")}
    for i in range(len(rows) + 1):
        for _ in range(3):  # inserts
            for told, (cost, audit) in list(layer.items()):
                for role in "ua":
                    if re.fullmatch(r"s?(ua)*u?", told + role):
                        short = shorten(told + role)
                        layer[short] = min(layer.get(short, (10**9, "")), (cost + 3, audit + "I"))
        if i == len(rows):
            break
        row, after = rows[i], {}
        for told, (cost, audit) in layer.items():
            more = 3 if row.truncated else 0
            ways = [(told, cost + 4, audit + "D")]
            if not row.must_go:
                ways += [(told + (row.initial or "?"), cost + more, audit + "K")] + [(told + r, cost + 3 + more, audit + "R") for r in "ua"]
            for new, c, a in ways:
                if new == told or (row.must_go is False and re.fullmatch(r"s?(ua)*u?", new) and len(new) > len(told)):
                    after[shorten(new)] = min(after.get(shorten(new), (10**9, "")), (c, a))
        layer = after
    return min(v for told, v in layer.items() if WHOLE.match(told))


def shorten(told):
    """Roles that go on alike: nothing, s, ..u, ..a."""
    return "" if not told else "s" if told == "s" else "u" if told[-1] == "u" else "ua"


@pytest.mark.parametrize("length", range(5))
def test_against_a_full_table(length):
    kinds = [Row(i, m, t) for i, m, t in itertools.product("sua", (False,), (False, True))] + [Row("u", True), Row("x")]
    for rows in itertools.product(kinds, repeat=length):
        cost, edits = repair.cheapest(list(rows))
        assert (cost, "".join(e for e, _ in edits)) == brute(list(rows)), rows


def test_longer_ones():
    rng = random.Random(3)
    for _ in range(300):
        rows = [Row(rng.choice("suaaux"), rng.random() < 0.1, rng.random() < 0.3) for _ in range(rng.randint(5, 60))]
        cost, edits = repair.cheapest(rows)
        assert (cost, "".join(e for e, _ in edits)) == brute(rows)


def test_a_very_long_one():
    rng = random.Random(8)
    rows = [Row("u" if i % 2 == 0 else "a", rng.random() < 0.05, rng.random() < 0.1) for i in range(60_000)]
    cost, edits = repair.cheapest(rows)
    table = [0, 10**9, 10**9, 10**9]

    def put(table):
        for s, o in ((0, 2), (1, 2), (2, 3), (3, 2), (2, 3)):
            table[o] = min(table[o], table[s] + 3)
        return table

    for row in rows:
        table, new = put(table), [c + 4 for c in table]
        if not row.must_go:
            for s in range(4):
                for role, o in repair.STEPS[s].items():
                    new[o] = min(new[o], table[s] + (0 if role == row.initial else 3 if role in "ua" else 10**9) + (3 if row.truncated else 0))
        table = new
    assert cost == min(put(table)[0], table[3]) and len(edits) == len(rows) + sum(e == "I" for e, _ in edits)


def by_hand(turns):
    """The contract, on Python lists: (conv_id, turn, role, text) rows."""
    out = {}
    for conv in {t[0] for t in turns}:
        rows = []
        for _, turn, role, text in [t for t in turns if t[0] == conv]:
            role, text = role if role is not None else " ", text if text is not None else " "
            draw = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
            text = "" if draw == 1 else re.sub("[.!?]", "", text) if draw == 2 else text
            rows += [(turn, "user" if draw == 4 else role, text)] * (0 if draw == 0 else 2 if draw == 3 else 1)
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, flags, n = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, role, text in rows:
            bare = text.strip("\t\n\v\f\r ")
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None
            seen.add((role, text))
            if fault:
                n[fault] += 1
            flags.append(Row(role[:1], fault in ("blank", "duplicate"), fault == "truncated"))
        illegal = sum(a.initial + b.initial not in ("su", "ua", "au") for a, b in zip(flags, flags[1:]))
        cost, audit = brute(flags)
        told, state, left = [], "", list(rows)
        for e in audit:
            turn, role, text = (None, None, "") if e == "I" else left.pop(0)
            if e == "D":
                continue
            if e in "IR":
                role = "assistant" if state == "u" else "user"
            state = role[:1]
            told.append(f"{role}:{text}")
        known = [r[0] for r in rows if r[0] is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        out[conv] = (gaps, n["blank"], n["duplicate"], n["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(told).encode()).hexdigest())
    return out


def test_query_against_the_contract(spark, tmp_path):
    rng = random.Random(2)
    turns = []
    for conv in [*range(150), None]:
        for turn in rng.sample(range(12), rng.randint(1, 9)):
            turns.append((conv, turn if rng.random() < 0.95 else None, rng.choice(["system", "user", "assistant", "user", "assistant", None, "", "tool"]), rng.choice(["Yes.", "no", "Why?  ", "", None, " \n", "é!", "a.b", "Yes."])))
    turns += [turns[0], turns[1], (500, None, "user", None)]
    spark.createDataFrame([(*t, "x") for t in turns], "conv_id long, turn long, role string, text string, audit string").repartition(4).write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r["conv_id"]: tuple(r)[1:] for r in repair.query(spark, str(tmp_path)).collect()}
    assert got == by_hand(turns)


def test_edited_rows(spark):
    turns = spark.createDataFrame([(1, 0, "user", "Hi."), (1, 1, "user", "Hi."), (1, 2, "user", "No."), (2, 0, "assistant", "So.")], "conv_id long, turn long, role string, text string")
    rows = [tuple(r) for r in repair.edited(turns).orderBy("conv_id", "position").collect()]
    assert rows == [(1, 0, "K", 0, "user", "Hi."), (1, 1, "D", 1, "user", "Hi."), (1, 2, "R", 2, "assistant", "No."), (2, 0, "I", None, "user", ""), (2, 1, "K", 0, "assistant", "So.")]
    assert [r["audit"] for r in repair.reports(turns).orderBy("conv_id").collect()] == ["KDR", "IK"]
