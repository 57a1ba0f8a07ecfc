"""Repair of conversation structure by generalised LR parsing with edit costs.

A conversation's roles are parsed with the LR tables of a role grammar. Each row may be
kept, given another role or deleted, and empty turns may be inserted; each action has a
cost. All readings are followed at once on a graph-structured stack: a stack top is an LR
state on a link to the node below it, nodes are shared, and readings with equal tops
merge into the one of least (cost, audit). The audit holds the initials of the edits
(Keep, Rerole, Delete, Insert) in order; among the cheapest the ASCII-least counts.

Only tops cross from row to row, each with its cost, its audit's rank among the others
and the running digest of its repaired text, so a conversation streams through a task
in bounded memory however many rows it has (but for its audit, a byte per row, which is
part of the result). What a row does to a set of tops depends on their relative costs
and ranks alone and is remembered.

Merging is exact. Readings are compared behind a row, where every audit ends with an
edit of that row and none is the beginning of another, so their order cannot change
with what follows.

Rows are ordered by turn (NULL first), then role, then text. The first fault of a row
counts: blank (no word), duplicate (role and text of an earlier row), truncated (its
last character that is not white space does not end a sentence). Blank and duplicate
rows must go; keeping a truncated one costs extra.

Defined results: a NULL role or text counts as one blank; rows with a NULL conv_id are
one conversation; a row marked in an optional boolean column ``dropped`` is not there,
but its conversation is; a conversation without rows has zeros, an empty audit and the
digest of the empty text; an empty table gives no rows; other columns are left out.
The grammar's stacks must be of bounded depth, as those of left-recursive rules are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlens.llm.common import SPACES, table
from cohortlens.llm.skew import lookup_join
from cohortlens.sources.tables import written

END = "$"
OK, TRUNCATED, GONE = 0, 1, 2
SEGMENT = 512


@dataclass(frozen=True)
class Settings:
    """The role grammar over role initials, the first head its start, and the costs of edits."""

    rules: tuple[tuple[str, str], ...] = (("C", ""), ("C", "T"), ("C", "sT"), ("T", "ua"), ("T", "Tua"))
    roles: dict[str, str] = field(default_factory=lambda: {"u": "user", "a": "assistant"})  # to insert or rerole to
    legal: tuple[str, ...] = ("su", "ua", "au")
    sentence_ends: str = ".!?"
    rerole: int = 2
    delete: int = 3
    insert: int = 2
    truncated: int = 1


class Tables:
    """LR(0) states of a grammar; reductions are allowed by the symbols that may follow a head."""

    def __init__(self, rules: tuple[tuple[str, str], ...]):
        self.rules = (("'", rules[0][0]), *rules)
        self.heads = {head for head, _ in rules}
        follow = self._follow()
        self.goto: list[dict[str, int]] = []
        self.reduce: list[dict[str, list[int]]] = []
        self.sole: list[int | None] = []
        states = [self._closure(frozenset([(0, 0)]))]
        for items in states:  # grows while new states are found
            moves, complete = {}, [r for r, dot in items if dot == len(self.rules[r][1])]
            for symbol in sorted({self.rules[r][1][dot] for r, dot in items if dot < len(self.rules[r][1])}):
                target = self._closure(
                    frozenset((r, d + 1) for r, d in items if d < len(self.rules[r][1]) and self.rules[r][1][d] == symbol)
                )
                if target not in states:
                    states.append(target)
                moves[symbol] = states.index(target)
            self.goto.append(moves)
            ahead: dict[str, list[int]] = {}
            for r in complete:
                for symbol in follow[self.rules[r][0]]:
                    ahead.setdefault(symbol, []).append(r)
            self.reduce.append(ahead)
            self.sole.append(complete[0] if len(complete) == len(items) == 1 and complete[0] else None)

    def _closure(self, items: frozenset) -> frozenset:
        found, todo = set(items), list(items)
        while todo:
            r, dot = todo.pop()
            body = self.rules[r][1]
            if dot < len(body) and body[dot] in self.heads:
                new = {(i, 0) for i, (head, _) in enumerate(self.rules) if head == body[dot]} - found
                found |= new
                todo += new
        return frozenset(found)

    def _follow(self) -> dict[str, set[str]]:
        empty: set[str] = set()
        first = {head: set() for head in ("'", *self.heads)}
        follow = {head: set() for head in ("'", *self.heads)}
        follow["'"].add(END)

        def starts(symbols: str) -> set[str]:
            out = set()
            for s in symbols:
                out |= first[s] if s in first else {s}
                if s not in empty:
                    return out
            return out | {""}

        size = -1
        while size != (size := len(empty) + sum(map(len, (*first.values(), *follow.values())))):
            for head, body in self.rules:
                begun = starts(body)
                first[head] |= begun - {""}
                empty |= {head} if "" in begun else set()
                for i, s in enumerate(body):
                    if s in follow:
                        behind = starts(body[i + 1 :])
                        follow[s] |= behind - {""} | (follow[head] if "" in behind else set())
        return follow


class Stacks:
    """The graph-structured stack: numbered nodes (state, node below), each made once and shared."""

    def __init__(self, rules: tuple[tuple[str, str], ...]):
        self._tables = Tables(rules)
        self._numbers: dict[tuple[int, int], int] = {}
        self._nodes: list[tuple[int, int]] = []
        self.start = self._node(0, -1)

    def _node(self, state: int, below: int) -> int:
        key = (state, below)
        if key not in self._numbers:
            self._numbers[key] = len(self._nodes)
            self._nodes.append(key)
        return self._numbers[key]

    def _reduced(self, node: int, rule: int) -> int:
        head, body = self._tables.rules[rule]
        for _ in body:
            node = self._nodes[node][1]
        return self._node(self._tables.goto[self._nodes[node][0]][head], node)

    def _readings(self, node: int, ahead: str) -> list[int]:
        """The node and all that reductions before the symbol make of it."""
        found = [node]
        for n in found:
            for rule in self._tables.reduce[self._nodes[n][0]].get(ahead, ()):
                if rule and (new := self._reduced(n, rule)) not in found:
                    found.append(new)
        return found

    def shift(self, node: int, symbol: str) -> list[int]:
        """The tops after a symbol, none if no reading allows it."""
        out = []
        for n in self._readings(node, symbol):
            state = self._tables.goto[self._nodes[n][0]].get(symbol)
            if state is not None and symbol not in self._tables.heads:
                top = self._node(state, n)
                while (rule := self._tables.sole[self._nodes[top][0]]) is not None:
                    top = self._reduced(top, rule)
                if top not in out:
                    out.append(top)
        return out

    def accepts(self, node: int) -> bool:
        return any(0 in self._tables.reduce[self._nodes[n][0]].get(END, ()) for n in self._readings(node, END))


@dataclass(frozen=True)
class Move:
    """One way through a row: turns inserted before it (initials), then its edit."""

    cost: int
    audit: str
    inserted: str
    role: str | None  # initial it is given; "" keeps its own, None deletes the row
    top: int


# A set of tops as far as decisions depend on it: (top, cost above the least, rank of its audit).
Shape = tuple[tuple[int, int, int], ...]


class Repairs:
    """Decisions for one grammar, remembered per row class and shape."""

    def __init__(self, settings: Settings = Settings()):
        self.settings = settings
        self.stacks = Stacks(settings.rules)
        self.begin: Shape = ((self.stacks.start, 0, 0),)
        self._moves_of: dict[tuple[int, str, int], list[Move]] = {}
        self._steps: dict[tuple[Shape, str, int], tuple[int, Shape, list[tuple[int, Move]]]] = {}
        self._ends: dict[Shape, tuple[int, int, Move]] = {}

    def _inserted(self, top: int) -> list[tuple[str, int]]:
        """The fewest turns to insert to get from a top to each other."""
        found = {top: ""}
        for n in found_order(found):
            for initial in self.settings.roles:
                for new in self.stacks.shift(n, initial):
                    found.setdefault(new, found[n] + initial)
        return [(roles, n) for n, roles in found.items()]

    def _moves(self, top: int, initial: str, fault: int) -> list[Move]:
        key = (top, initial, fault)
        if key not in self._moves_of:
            s, out = self.settings, []
            extra = s.truncated if fault == TRUNCATED else 0
            for roles, n in self._inserted(top):
                cost, audit = s.insert * len(roles), "I" * len(roles)
                out.append(Move(cost + s.delete, audit + "D", roles, None, n))
                if fault != GONE:
                    out += [Move(cost + extra, audit + "K", roles, "", m) for m in self.stacks.shift(n, initial)]
                    for r in s.roles:
                        out += [Move(cost + extra + s.rerole, audit + "R", roles, r, m) for m in self.stacks.shift(n, r)]
            self._moves_of[key] = out
        return self._moves_of[key]

    def step(self, shape: Shape, initial: str, fault: int) -> tuple[int, Shape, list[tuple[int, Move]]]:
        """After a row: how much the least cost grows, the new shape, and per new top where it came from."""
        key = (shape, initial, fault)
        if key not in self._steps:
            best: dict[int, tuple[int, int, str, int, Move]] = {}
            for at, (top, cost, rank) in enumerate(shape):
                for move in self._moves(top, initial, fault):
                    made = (cost + move.cost, rank, move.audit, at, move)
                    if move.top not in best or made[:3] < best[move.top][:3]:
                        best[move.top] = made
            least = min(b[0] for b in best.values())
            order = sorted({b[1:3] for b in best.values()})
            new = tuple((top, b[0] - least, order.index(b[1:3])) for top, b in sorted(best.items()))
            self._steps[key] = least, new, [(b[3], b[4]) for _, b in sorted(best.items())]
        return self._steps[key]

    def finish(self, shape: Shape) -> tuple[int, int, Move]:
        """The final cost above the least, the place of the best top, and what it inserts at the end."""
        if shape not in self._ends:
            ends = [
                (cost + self.settings.insert * len(roles), rank, "I" * len(roles), at, roles, n)
                for at, (top, cost, rank) in enumerate(shape)
                for roles, n in self._inserted(top)
                if self.stacks.accepts(n)
            ]
            cost, _, audit, at, roles, n = min(ends, key=lambda e: e[:3])
            self._ends[shape] = cost, at, Move(cost, audit, roles, None, n)
        return self._ends[shape]


def found_order(found: dict[int, str]) -> Iterator[int]:
    """The keys of a dict that grows while it is walked, in the order they came."""
    at = 0
    while at < len(found):
        yield list(found)[at]
        at += 1


class Conversation:
    """Streams one conversation's rows through the tops."""

    def __init__(self, repairs: Repairs):
        self._repairs = repairs
        self._shape, self._cost = repairs.begin, 0
        # Per top: the audit as (packed segments before, tail) and the digest so far.
        self._runs = [((None, ""), hashlib.sha256(), True)]
        self.blank = self.duplicate = self.truncated = self.illegal = self.rows = 0
        self._turns = self._low = self._turn = None
        self._before: tuple[str, str] | None = None
        self._initial = None

    def _fault(self, turn: int | None, role: str, text: str, seen: bool) -> int:
        ends = text.rstrip(SPACES)
        again = seen or (self.rows and turn == self._turn and (role, text) == self._before)
        if not ends:
            self.blank += 1
        elif again:
            self.duplicate += 1
        elif ends[-1] not in self._repairs.settings.sentence_ends:
            self.truncated += 1
            return TRUNCATED
        else:
            return OK
        return GONE

    def add(self, turn: int | None, role: str, text: str, seen: bool) -> None:
        """``seen``: a row of an earlier turn has this role and text."""
        fault, initial = self._fault(turn, role, text, seen), role[:1]
        if self.rows and self._initial + initial not in self._repairs.settings.legal:
            self.illegal += 1
        if turn is not None:
            if self._turns is None:
                self._turns, self._low = 1, turn
            elif turn != self._turn:
                self._turns += 1
        self.rows += 1
        self._turn, self._before, self._initial = turn, (role, text), initial
        grown, shape, origins = self._repairs.step(self._shape, initial, fault)
        runs, own = [], None
        for at, move in origins:
            (packed, tail), digest, empty = self._runs[at]
            tail += move.audit
            if len(tail) >= SEGMENT:
                packed, tail = (packed, tail), ""
            if move.inserted or move.role is not None:
                digest = digest.copy()
                empty = self._write(digest, empty, move.inserted)
                if move.role is not None:
                    own = text.encode() if own is None else own
                    name = self._repairs.settings.roles[move.role] if move.role else role
                    digest.update(("" if empty else "\n").encode() + name.encode() + b":" + own)
                    empty = False
            runs.append(((packed, tail), digest, empty))
        self._shape, self._runs = shape, runs
        self._cost += grown

    def _write(self, digest, empty: bool, inserted: str) -> bool:
        for initial in inserted:
            digest.update((("" if empty else "\n") + self._repairs.settings.roles[initial] + ":").encode())
            empty = False
        return empty

    def result(self) -> tuple[int, int, int, int, int, int, str, str]:
        """gaps, blank, duplicate, truncated, illegal, cost, audit, digest of the repaired text."""
        more, at, move = self._repairs.finish(self._shape)
        (packed, tail), digest, empty = self._runs[at]
        digest = digest.copy()
        self._write(digest, empty, move.inserted)
        parts = [tail + move.audit]
        while packed is not None:
            packed, part = packed
            parts.append(part)
        gaps = 0 if self._turns is None else self._turn - self._low + 1 - self._turns
        counts = (gaps, self.blank, self.duplicate, self.truncated, self.illegal, self._cost + more)
        return *counts, "".join(reversed(parts)), digest.hexdigest()


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_RESULT = ", ".join(f"{c} long" for c in COUNTS) + ", audit string, repaired_sha256 string"


def _rows(conversations: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text, there), NULL roles and texts as one blank."""
    there = ~F.coalesce(F.col("dropped"), F.lit(False)) if "dropped" in conversations.columns else F.lit(True)
    filled = [F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")]
    return conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), *filled, there.alias("there"))


def _marked(rows: DataFrame) -> DataFrame:
    """Adds ``seen``: a row of an earlier turn of the conversation has the same role and text.

    The first turn of each (conversation, role, text) comes from one aggregation, combined in
    the map tasks; only those in several rows are looked up, hot ones where the rows are.
    """
    conv = F.coalesce(F.col("conv_id").cast("string"), F.lit("-"))
    key = F.sha2(F.concat_ws(":", conv, F.length("role").cast("string"), F.concat("role", "text")), 256)
    keyed = rows.withColumn("_same", F.when(F.col("there"), key))
    at = F.coalesce(F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn")))
    firsts = keyed.filter("there").groupBy("_same").agg(F.min(at).alias("_first"), F.count("*").alias("_n"))
    found = lookup_join(keyed, written(firsts.filter("_n > 1")), "_same", "_n")
    later = ~F.col("_first.known") & F.col("turn").isNotNull() | (F.col("_first.turn") < F.col("turn"))
    return found.select(*rows.columns, F.coalesce(later, F.lit(False)).alias("seen"))


def _in_order(rows: DataFrame, *first: str) -> DataFrame:
    dealt = rows.repartition("conv_id")
    return dealt.sortWithinPartitions("conv_id", *first, F.asc_nulls_first("turn"), "role", "text")


def repair(conversations: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256."""
    schema = T.StructType([conversations.schema["conv_id"], *T._parse_datatype_string(_RESULT)])
    dealt = _in_order(_marked(_rows(conversations)), F.desc("there"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repairs, conv, held, out = Repairs(settings), None, None, []
        to_arrow = arrow_schema(schema)
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "there", "turn", "role", "text", "seen")]
            for own, there, turn, role, text, seen in zip(*columns, strict=True):
                if held is None or own != conv:
                    if held is not None:
                        out.append((conv, *held.result()))
                    conv, held = own, Conversation(repairs)
                if there:
                    held.add(turn, role, text, seen)
            yield made(out, to_arrow)
            out = []
        if held is not None:
            yield made([(conv, *held.result())], to_arrow)

    return dealt.mapInArrow(run, schema)


def arrow_schema(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def made(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def repaired_turns(conversations: DataFrame, repaired: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The repaired conversations: rows (conv_id, turn, role, text, edit), turns from 0, edit K, R or I.

    ``repaired`` is the result of ``repair`` for the same rows. Each audit leads its
    conversation's rows through the task, so neither is joined to the other.
    """
    kept = _rows(conversations).filter("there").withColumn("audit", F.lit(None).cast("string"))
    lead = repaired.select(
        "conv_id", F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.lit("").alias("text"),
        F.lit(True).alias("there"), "audit",
    )
    dealt = _in_order(kept.unionByName(lead), F.col("audit").isNull())
    out_type = T.StructType(
        [conversations.schema["conv_id"], *T._parse_datatype_string("turn long, role string, text string, edit string")]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stacks, to_arrow = Repairs(settings).stacks, arrow_schema(out_type)
        conv, audit, at, turn, top = None, "", 0, 0, stacks.start

        def given(edit: str, own: str | None) -> str:
            """The role of the next turn: its own, or the one that the grammar allows and that can lead on."""
            nonlocal top
            for initial in [own[:1]] if edit == "K" else settings.roles:
                if tops := stacks.shift(top, initial):
                    top = tops[0]
                    return own if edit == "K" else settings.roles[initial]
            raise ValueError("the audit does not fit the rows")

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "role", "text", "audit")]
            out = []
            for own, role, text, lead_audit in zip(*columns, strict=True):
                if lead_audit is not None:
                    conv, audit, at, turn, top = own, lead_audit, 0, 0, stacks.start
                else:
                    edit, at = audit[at], at + 1
                    if edit != "D":
                        out.append((conv, turn, given(edit, role), text, edit))
                        turn += 1
                while at < len(audit) and audit[at] == "I":
                    out.append((conv, turn, given("I", None), "", "I"))
                    turn, at = turn + 1, at + 1
            yield made(out, to_arrow)

    return dealt.mapInArrow(run, out_type)


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows with faults planted by crc32(``conv_id:turn``) mod 20: 0 drops a row (it stays with
    ``dropped`` true), 1 empties its text, 2 removes its sentence ends, 3 repeats it, 4 sets its role to
    user. NULLs count as one blank."""
    named = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.pmod(F.crc32(F.concat_ws(":", named("conv_id"), named("turn"))), F.lit(20))
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(named("text"), "[.!?]", "")).otherwise(named("text"))
    role = F.when(kind == 4, "user").otherwise(named("role"))
    copies = F.sequence(F.lit(1), F.when(kind == 3, 2).otherwise(1))
    rows = conversations.select(
        "conv_id", "turn", role.alias("role"), text.alias("text"), (kind == 0).alias("dropped"), F.explode(copies)
    )
    return rows.drop("col")


def op11_role_repair(spark, sf_dir: str) -> DataFrame:
    """All conversations, damaged and repaired."""
    return repair(damaged(table(spark, sf_dir, "conversations")))
