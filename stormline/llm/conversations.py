"""Operator 13: repair of conversations by a Viterbi walk whose survivors coalesce.

A conversation is a sequence of turns that should read (system)? (user assistant)+. The walk keeps one
cheapest way (a survivor) into each of four states. Survivors share a tree of back pointers; each node
counts the nodes and survivors that point at it. The part of the tree that all survivors have in common
is decided for good: its edits are emitted and their texts freed, so a conversation of any length needs
memory for the undecided end alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stormline.registry import table

KEEP, REROLE, DELETE, INSERT, CUT_SHORT = 0, 3, 4, 3, 3
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
BEFORE_USER = (EMPTY, SYSTEM, ASSISTANT)
BLANK, DUPLICATE, TRUNCATED = "blank", "duplicate", "truncated"
EMIT_EVERY = 16


class Node:
    """One edit on the way to a survivor: its initial, the line it leaves (None if none), and who points at it."""

    __slots__ = ("letter", "line", "parent", "refs")

    def __init__(self, parent: Node | None, letter: str, line: str | None) -> None:
        self.parent, self.letter, self.line, self.refs = parent, letter, line, 0
        if parent is not None:
            parent.refs += 1


def forget(node: Node | None) -> None:
    """Frees the branch that nothing points at any more."""
    while node is not None and node.refs == 0 and node.parent is not None:
        above, node.parent = node.parent, None
        above.refs -= 1
        node = above


class Walk:
    """The survivors of one conversation, and the edits decided so far."""

    def __init__(self) -> None:
        self.root = Node(None, "", None)
        self.root.refs = 1
        self.alive: dict[int, tuple[int, Node]] = {EMPTY: (0, self.root)}
        self.audit: list[str] = []
        self.text = hashlib.sha256()
        self.lines = self.steps = self.most_open = 0
        self._insert(self.alive)

    def _open(self, node: Node) -> list[Node]:
        """The undecided edits that lead to a node, oldest first."""
        way = []
        while node is not self.root:
            way.append(node)
            node = node.parent
        return way[::-1]

    def _less(self, a: Node, b: Node) -> bool:
        """Of two ways of one cost: by their complete undecided edits. One is never the start of the other, as it would be dearer."""
        return [x.letter for x in self._open(a)] < [x.letter for x in self._open(b)]

    def _offer(self, to: dict[int, tuple[int, Node]], state: int, cost: int, node: Node) -> None:
        held = to.get(state)
        if held is None or cost < held[0] or (cost == held[0] and self._less(node, held[1])):
            to[state] = (cost, node)
            node.refs += 1
            if held is not None:
                held[1].refs -= 1
                forget(held[1])
        else:
            forget(node)

    def _insert(self, to: dict[int, tuple[int, Node]]) -> None:
        """Empty turns anywhere: up to two in a row lead from any state to any other that inserts can reach."""
        for _ in range(2):
            for state in list(to):
                cost, node = to[state]
                if state == USER:
                    self._offer(to, ASSISTANT, cost + INSERT, Node(node, "I", "assistant:"))
                else:
                    self._offer(to, USER, cost + INSERT, Node(node, "I", "user:"))

    def row(self, role: str, text: str, fault: str | None) -> None:
        to: dict[int, tuple[int, Node]] = {}
        more = CUT_SHORT if fault == TRUNCATED else 0
        initial, kept = role[:1], f"{role}:{text}"
        for state, (cost, node) in self.alive.items():
            self._offer(to, state, cost + DELETE, Node(node, "D", None))
            if fault in (BLANK, DUPLICATE):
                continue
            if initial == "s" and state == EMPTY:
                self._offer(to, SYSTEM, cost + KEEP + more, Node(node, "K", kept))
            if state == USER:
                keeps, after, name = initial == "a", ASSISTANT, "assistant"
            else:
                keeps, after, name = initial == "u", USER, "user"
            if keeps:
                self._offer(to, after, cost + KEEP + more, Node(node, "K", kept))
            else:
                self._offer(to, after, cost + REROLE + more, Node(node, "R", f"{name}:{text}"))
        self._insert(to)
        best = to[ASSISTANT][0]
        # what follows nothing or a system turn can follow an assistant turn too, but for one system turn, which costs a Delete
        for state, spare in ((EMPTY, DELETE), (SYSTEM, 0)):
            if state in to and to[state][0] > best + spare:
                to[state][1].refs -= 1
                forget(to.pop(state)[1])
        for _, node in self.alive.values():
            node.refs -= 1
            forget(node)
        self.alive = to
        self.steps += 1
        if self.steps % EMIT_EVERY == 0:
            self._emit()

    def _emit(self) -> None:
        """Writes out what every survivor has in common."""
        way = self._open(next(iter(self.alive.values()))[1])
        self.most_open = max(self.most_open, len(way))
        tips = {id(node) for _, node in self.alive.values()}
        if id(self.root) in tips:
            return
        for node in way:
            if self.root.refs > 1:  # its only pointer is the one child on this way
                break
            self._write(node)
            self.root.refs, node.parent, self.root = 0, None, node
            if id(node) in tips:
                break

    def _write(self, node: Node) -> None:
        self.audit.append(node.letter)
        if node.line is not None:
            self.text.update(("\n" if self.lines else "").encode() + node.line.encode())
            self.lines += 1

    def end(self) -> tuple[int, str, str]:
        """Cost, audit and the repaired text's digest: the cheapest accepted way, ties by the edits' initials."""
        cost, node = self.alive[ASSISTANT]
        if EMPTY in self.alive:
            c, n = self.alive[EMPTY]
            if c < cost or (c == cost and self._less(n, node)):
                cost, node = c, n
        for x in self._open(node):
            self._write(x)
        return cost, "".join(self.audit), self.text.hexdigest()


class Conversation:
    """Counts and walk of one conversation whose rows come in order."""

    def __init__(self, conv: object) -> None:
        self.conv, self.walk, self.last = conv, Walk(), None
        self.low = self.high = self.turn = None
        self.turns = self.illegal = self.rows = 0
        self.faults = {BLANK: 0, DUPLICATE: 0, TRUNCATED: 0}

    def row(self, turn: int | None, role: str, text: str, fault: str | None) -> None:
        self.rows += 1
        if turn is not None:
            self.turns += turn != self.turn
            self.low, self.high, self.turn = turn if self.low is None else self.low, turn, turn
        if self.last is not None and self.last + role[:1] not in ("su", "ua", "au"):
            self.illegal += 1
        self.last = role[:1]
        if fault:
            self.faults[fault] += 1
        self.walk.row(role, text, fault)

    def result(self) -> dict:
        cost, audit, digest = self.walk.end()
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return {"conv_id": self.conv, "gaps": gaps, **self.faults, "illegal": self.illegal, "cost": cost, "audit": audit, "repaired_sha256": digest}


def _walked(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows in order of conversation and turn; a conversation may go on over any number of batches."""
    now: Conversation | None = None
    done: list[dict] = []
    for batch in batches:
        columns = [batch.column(n).to_pylist() for n in ("conv_id", "turn", "role", "text", "fault", "copies", "first")]
        for conv, turn, role, text, fault, copies, first in zip(*columns, strict=True):
            if now is None or now.conv != conv:
                if now is not None:
                    done.append(now.result())
                now = Conversation(conv)
            for k in range(copies):
                now.row(turn, role, text, fault if fault == BLANK else DUPLICATE if k or not first else fault)
        if done:
            yield pa.RecordBatch.from_pylist(done, schema)
            done = []
    if now is not None:
        yield pa.RecordBatch.from_pylist([now.result()], schema)


RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def repair_conversations(rows: DataFrame, conv: str, turn: str, role: str, text: str, copies: Column | None = None) -> DataFrame:
    """One row a conversation: conv_id, faults counted, the cheapest repair's cost, audit and digest.

    Rows go by turn, null turns first; rows of one turn by role, then text. Each row's first fault
    counts: blank, duplicate (role and text came earlier in the conversation), truncated. `copies`
    repeats a row in place; a conversation all of whose rows have 0 copies gives zeros, an empty audit
    and the digest of an empty text. Null roles and texts count as one space; rows with a null
    conversation id form one conversation; other columns aren't read, whatever their names; no rows
    give no rows. Equal rows of one turn are counted before any shuffle. A conversation is one sequence
    and so one task's stream, however long, but never held as a whole.
    """
    n = F.lit(1) if copies is None else copies
    plain = rows.select(
        F.col(conv).alias("conv_id"), F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role), F.lit(" ")).alias("role"), F.coalesce(F.col(text), F.lit(" ")).alias("text"), n.cast("long").alias("copies"),
    ).withColumns({c: F.when(F.col("copies") > 0, F.col(c)) for c in ("role", "text")})
    once = plain.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    last = F.regexp_extract("text", r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)
    fault = F.when(last == "", BLANK).when(~last.isin(".", "!", "?"), TRUNCATED)
    keyed = once.select("*", fault.alias("fault"), F.md5(F.concat(F.col("role"), F.lit("\0"), F.col("text"))).alias("same"))
    # ties of one conversation, role and text are told apart by turn alone: a minimum, not a sort of what may be most rows
    place = F.struct(F.col("turn").isNotNull().alias("has"), F.coalesce("turn", F.lit(0)).alias("turn"))
    firsts = keyed.where("copies > 0").groupBy(F.col("conv_id").alias("_conv"), F.col("same").alias("_same")).agg(F.min(place).alias("_place"))
    told = keyed.join(firsts, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("same") == F.col("_same")), "left")
    told = told.select("conv_id", "turn", "role", "text", "fault", "copies", F.coalesce(F.col("_place") == place, F.lit(True)).alias("first"))
    kind = rows.schema[conv].dataType.simpleString()
    schema = f"conv_id {kind}, {RESULT}"
    dealt = told.repartition("conv_id").sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text")
    empty = rows.sparkSession.createDataFrame([], schema).schema

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        yield from _walked(batches, to_arrow_schema(empty))

    return dealt.mapInArrow(walk, schema)


def damaged(rows: DataFrame) -> DataFrame:
    """The damage of the contract, by crc32 of `conv_id:turn` modulo 20; column `copies`: 0 dropped, 2 repeated, else 1."""
    said = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    kind = F.crc32(F.concat(said[0], F.lit(":"), said[1])) % 20
    text, role = F.coalesce(F.col("text"), F.lit(" ")), F.coalesce(F.col("role"), F.lit(" "))
    return rows.select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"),
    )


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_conversations(damaged(table(spark, sf_dir, "conversations")), "conv_id", "turn", "role", "text", F.col("copies"))
