r"""Conversation structure repair: the cheapest edits that make turns alternate, by bidirectional Dijkstra over the edit lattice.

A node of the lattice is (rows read, state); the states are what the roles so far end in: nothing, a system turn, a user turn,
an assistant turn. From each state an initial leads to one other at most, and a conversation is whole if it ends in the first
or the last, so the roles' initials are ``(s?(ua)+)?``. Edges are the edits: Keep (0), Rerole to user or assistant (3), Delete
(4; all that a blank or repeated row allows), Insert an empty user or assistant turn (3); a truncated row that stays adds 3.

Two searches, from the start and from the ends, settle nodes by cost until the sum of their least open costs is above the best
path seen. Every node of every cheapest path is then settled by one of them, so all crossings of equal cost are known. The
forward nodes that reach a crossing are marked, and the least audit is walked along them, over a crossing, and along the
backward nodes: an edit's letter fixes where it leads, and no cheapest audit is the beginning of another between the same
nodes, so taking the least letter each time gives the least concatenation.

Faults of a row: blank (nothing but white space), duplicate (role and text seen earlier in the conversation), truncated (its
last character that isn't white space ends no sentence); the first that holds counts.

Defined cases: a null role or text is one space, and so is a null id or turn where the damage is drawn; rows of a null
conversation are one conversation. A role that begins with none of s, u and a, or is empty, can't be kept. Rows are taken by turn, null turns first, then by role and text; repeated rows stay and
count as duplicates. A conversation without rows has zeros, an empty audit and the hash of an empty text. An empty table gives
an empty result; other columns are not looked at.

A conversation's audit and hash are single values, so its rows pass one task, one after another, sorted by Spark. The task
keeps some bytes a row (role, faults, a digest); texts wait in a spool that goes to an unlinked file of the task above
``SPOOL`` bytes. Different conversations are dealt by their id, however many there are.
"""

from __future__ import annotations

import hashlib
import heapq
import pickle
import re
import tempfile
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
SPOOL = 32 << 20
#: States: nothing yet, after a system, a user, an assistant turn; and where an initial leads from each.
STEPS = [{"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2}]
ROLE = {"u": "user", "a": "assistant"}
ENDS = (0, 3)
SPACE = "\t\n\v\f\r "
END = re.compile(r"[.!?]\Z")
FAR = 1 << 60


@dataclass
class Row:
    """What the lattice asks of a row: its role's initial, whether it must go, whether it is truncated."""

    initial: str
    must_go: bool = False
    truncated: bool = False


def _ahead(rows: list[Row], node: int) -> Iterator[tuple[str, int, int]]:
    """Edits at a node by letter: (letter, cost, next node)."""
    i, state = divmod(node, 4)
    steps = STEPS[state]
    row = rows[i] if i < len(rows) else None
    if row:
        yield "D", DELETE, node + 4
    for role in "ua":
        if role in steps:
            yield "I", INSERT, i * 4 + steps[role]
    if row and not row.must_go:
        more = TRUNCATED if row.truncated else 0
        if row.initial in steps:
            yield "K", KEEP + more, i * 4 + 4 + steps[row.initial]
        for role in "ua":
            if role in steps:
                yield "R", REROLE + more, i * 4 + 4 + steps[role]


def _behind(rows: list[Row], node: int) -> Iterator[tuple[int, int]]:
    """(cost, node before) of the edits that lead to a node."""
    i, state = divmod(node, 4)
    last = "-sua"[state]
    from_ = [s for s in range(4) if STEPS[s].get(last) == state]
    if last in "ua":
        for s in from_:
            yield INSERT, i * 4 + s
    if not i:
        return
    row = rows[i - 1]
    yield DELETE, node - 4
    if not row.must_go:
        more = TRUNCATED if row.truncated else 0
        for s in from_:
            if row.initial == last:
                yield KEEP + more, i * 4 - 4 + s
            if last in "ua":
                yield REROLE + more, i * 4 - 4 + s


@dataclass
class Search:
    """One of the two: least known cost of each node, the open ones, and those settled in their order."""

    known: list[int]
    open: list[tuple[int, int]] = field(default_factory=list)
    settled: list[int] = field(default_factory=list)
    done: bytearray = field(default_factory=bytearray)
    sign: int = 1

    def top(self) -> int:
        while self.open and self.done[self.sign * self.open[0][1]]:
            heapq.heappop(self.open)
        return self.open[0][0] if self.open else FAR

    def reach(self, node: int, cost: int) -> None:
        if cost < self.known[node]:
            self.known[node] = cost
            heapq.heappush(self.open, (cost, self.sign * node))

    def settle(self) -> int:
        node = self.sign * heapq.heappop(self.open)[1]
        self.done[node] = 1
        self.settled.append(node)
        return node


def cheapest(rows: list[Row]) -> tuple[int, list[tuple[str, int]]]:
    """Least cost, and the edits of the ASCII-least audit as (letter, state that it leads to)."""
    size = 4 * (len(rows) + 1)
    ends = [4 * len(rows) + s for s in ENDS]
    # of equal costs the forward search takes earlier rows first and the other later ones: edits that cost nothing lead on
    ahead, behind = (Search([FAR] * size, done=bytearray(size), sign=s) for s in (1, -1))
    ahead.reach(0, 0)
    for e in ends:
        behind.reach(e, 0)
    best = FAR if rows else 0
    while (a := ahead.top()) + (b := behind.top()) <= best and min(a, b) < FAR:
        if b <= a:
            node = behind.settle()
            for cost, other in _behind(rows, node):
                behind.reach(other, b + cost)
        else:
            node = ahead.settle()
            for _, cost, other in _ahead(rows, node):
                ahead.reach(other, a + cost)
        best = min(best, ahead.known[node] + behind.known[node])
    good = bytearray(size)

    def leads(cost: int, node: int) -> bool:
        return bool(behind.done[node]) and cost + behind.known[node] == best or bool(good[node]) and cost == ahead.known[node]

    for node in reversed(ahead.settled):
        good[node] = any(leads(ahead.known[node] + cost, other) for _, cost, other in _ahead(rows, node))
    node, spent, edits = 0, 0, []
    while not (node in ends and spent == best):
        letter, cost, node = next(e for e in sorted(_ahead(rows, node)) if leads(spent + e[1], e[2]))
        spent += cost
        edits.append((letter, node % 4))
    return best, edits


class Conversation:
    """The rows of one conversation as they come, and what becomes of them."""

    def __init__(self, conv_id: int | None) -> None:
        self.conv_id = conv_id
        self.rows: list[Row] = []
        self.seen: set[bytes] = set()
        self.texts = tempfile.SpooledTemporaryFile(SPOOL)
        self.counts = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
        self.least = self.most = None
        self.turns = 0

    def take(self, turn: int | None, role: str, text: str) -> None:
        if turn is not None:
            self.turns += turn != self.most
            self.least, self.most = turn if self.least is None else self.least, turn
        held = text.rstrip(SPACE)
        digest = hashlib.blake2b(f"{len(role)}:{role}{text}".encode("utf-8", "surrogatepass"), digest_size=16).digest()
        fault = "blank" if not held else "duplicate" if digest in self.seen else "truncated" if not END.search(held) else None
        self.seen.add(digest)
        if fault:
            self.counts[fault] += 1
        row = Row(role[:1], fault in ("blank", "duplicate"), fault == "truncated")
        if self.rows and self.rows[-1].initial + row.initial not in ("su", "ua", "au"):
            self.counts["illegal"] += 1
        self.rows.append(row)
        pickle.dump((turn, role, text), self.texts, pickle.HIGHEST_PROTOCOL)

    def repaired(self) -> tuple[dict, Iterator[tuple[str, int | None, str, str]]]:
        """The report, whose ``repaired_sha256`` is there once the edited rows (letter, turn, role, text) have been read; D rows are what was deleted."""
        cost, edits = cheapest(self.rows)
        gaps = self.most - self.least + 1 - self.turns if self.turns else 0
        report = {"conv_id": self.conv_id, "gaps": gaps, **self.counts, "cost": cost, "audit": "".join(e for e, _ in edits)}

        def out() -> Iterator[tuple[str, int | None, str, str]]:
            digest, first = hashlib.sha256(), True
            self.texts.seek(0)
            for letter, state in edits:
                made = ROLE.get("-sua"[state])
                turn, role, text = (None, made, "") if letter == "I" else pickle.load(self.texts)
                role = made if letter == "R" else role
                if letter != "D":
                    digest.update((("" if first else "\n") + f"{role}:{text}").encode("utf-8", "surrogatepass"))
                    first = False
                yield letter, turn, role, text
            report["repaired_sha256"] = digest.hexdigest()
            self.texts.close()

        return report, out()


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[Conversation]:
    now = None
    for b in batches:
        for conv_id, turn, role, text, there in zip(*[c.to_pylist() for c in b.columns]):
            if now is None or conv_id != now.conv_id:
                if now is not None:
                    yield now
                now = Conversation(conv_id)
            if there:
                now.take(turn, role, text)
    if now is not None:
        yield now


def _sorted(turns: DataFrame) -> DataFrame:
    """Rows in the order in which conversations are read; ``there`` is false for what only says that the conversation exists."""
    there = F.col("there") if "there" in turns.columns else F.lit(True)
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), there.alias("there"))
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text")


def reports(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text (and ``there``) to one row a conversation: faults, cost, audit and hash of the repaired one."""
    whole = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    schema = pa.schema([("conv_id", pa.int64()), *[(c, pa.int64()) for c in whole], ("audit", pa.string()), ("repaired_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for one in _conversations(batches):
            report, rows = one.repaired()
            for _ in rows:
                pass
            held.append(report)
            if len(held) == 1000:
                yield pa.RecordBatch.from_pylist(held, schema)
                held = []
        yield pa.RecordBatch.from_pylist(held, schema)

    return _sorted(turns).mapInArrow(run, f"conv_id long, {', '.join(f'{c} long' for c in whole)}, audit string, repaired_sha256 string")


def edited(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text to the edits themselves: conv_id, position, edit, turn, role, text; what was deleted has edit D."""
    schema = pa.schema([("conv_id", pa.int64()), ("position", pa.int64()), ("edit", pa.string()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for one in _conversations(batches):
            for i, (letter, turn, role, text) in enumerate(one.repaired()[1]):
                held.append((one.conv_id, i, letter, turn, role, text))
                size += len(text)
                if len(held) == 10_000 or size > SPOOL:
                    yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in held], schema)
                    held, size = [], 0
        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in held], schema)

    return _sorted(turns).mapInArrow(run, "conv_id long, position long, edit string, turn long, role string, text string")


def damaged(turns: DataFrame) -> DataFrame:
    """Rows with faults drawn by their id and turn; dropped ones stay with ``there`` false, so that no conversation is forgotten."""
    def shown(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    draw = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn"))) % 20
    rows = turns.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), draw.alias("draw"))
    text = F.when(F.col("draw") <= 1, "").when(F.col("draw") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.explode(F.when(F.col("draw") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.select("conv_id", "turn", F.when(F.col("draw") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), (F.col("draw") != 0).alias("there"), copies.alias("_copy")).drop("_copy")


def query(spark, sf_dir: str) -> DataFrame:
    return reports(damaged(spark.read.parquet(f"{sf_dir}/conversations.parquet")))
