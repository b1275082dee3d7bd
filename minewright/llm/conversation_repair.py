"""Operator 13: repair of conversation structure by depth-first branch and bound.

A conversation's rows, in the order (turn, role, text) with nulls first, are kept, given another role or deleted, and empty
turns are inserted, so that the role initials read ``(s?(ua)+)?`` at the least cost; among edits of that cost the one whose
letters are least in ASCII wins. The search is a depth-first walk over nodes (row, state of the pattern) with an explicit
stack. Children are tried in the order of their letters, so among equal costs the first arrival is the least audit. Three
things prune it: lower bounds of the rows that are left (their exact cost where the pattern may stop anywhere), the
incumbent's (cost, audit), first set by a greedy dive, and a table of the least cost that reached each node.

Rows of a conversation stream through one task in order, since its output is one sequence; what the task holds does not
grow with the conversation, apart from one letter an edit and 16 bytes a row that shares a turn. A long one is solved in pieces of ``PIECE_ROWS`` rows, from
every state to every state; the four paths carried forward share what they agree on, which is given out at once. Whether a
row repeats an earlier one is found before, by grouping hashes of all rows, so no set of seen texts is held either:
a conversation with a third of all rows, or a text that all its rows repeat, spills instead of filling memory.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from minewright.llm import blocks as B

# Fixed values of the task: costs of the edits, and of a truncated row that stays.
RENAME, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
BLANKS = " \t\n\x0b\x0c\r"
PIECE_ROWS = 256
PIECE_CHARS = 1 << 20
EMITTED_ROWS = 2_000
# States of the pattern: nothing yet, behind s, behind u, behind a. A turn may follow each; only the first and last accept.
START, SYSTEM, USER, REPLY = range(4)
ENDS = (START, REPLY)
_NEXT = (USER, USER, REPLY, USER)
_KEEP = ({"u": USER, "s": SYSTEM}, {"u": USER}, {"a": REPLY}, {"u": USER})
_REACH = ((START, SYSTEM, USER, REPLY), (SYSTEM, USER, REPLY), (USER, REPLY), (USER, REPLY))
_NEW_ROLE = ("user", "user", "assistant", "user")
_FAR = 1 << 60


def children(row: tuple[str, bool, int], state: int) -> list[tuple[str, int, int]]:
    """(letter, cost, next state) of the edits that use up a row, by letter; a row is (initial, must go, penalty)."""
    initial, must_go, penalty = row
    out = [("D", DELETE, state)]
    if not must_go:
        kept = _KEEP[state].get(initial)
        if kept is not None:
            out.append(("K", penalty, kept))
        out.append(("R", RENAME + penalty, _NEXT[state]))
    return out


def suffix_bounds(rows: list[tuple[str, bool, int]]) -> list[list[int]]:
    """Least cost of the rows from each place on, from each state, where any state may be the last."""
    bounds = [[0] * 4]
    for row in reversed(rows):
        behind = bounds[-1]
        own = [min(cost + behind[to] for _, cost, to in children(row, s)) for s in range(4)]
        for _ in range(2):
            own = [min(own[s], INSERT + own[_NEXT[s]]) for s in range(4)]
        bounds.append(own)
    return bounds[::-1]


def _dive(rows: list[tuple[str, bool, int]], bounds: list[list[int]], entry: int, exits: tuple[int, ...]) -> int:
    """Cost of one way to an exit, taking the child of the least bound each time."""
    if not any(x in _REACH[USER] for x in exits):
        return _FAR
    cost, at, state = 0, 0, entry
    while at < len(rows):
        least, step, forward, to = min(
            [(c + bounds[at + 1][t], c, 1, t) for _, c, t in children(rows[at], state)]
            + [(INSERT + bounds[at][_NEXT[state]], INSERT, 0, _NEXT[state])]
        )
        cost, at, state = cost + step, at + forward, to
    while state not in exits:
        cost, state = cost + INSERT, _NEXT[state]
    return cost


def search(
    rows: list[tuple[str, bool, int]], bounds: list[list[int]], entry: int, exits: tuple[int, ...]
) -> tuple[int, str, int] | None:
    """The least (cost, audit) of edits that lead from ``entry`` behind the last row in one of ``exits``, and that exit."""
    count = len(rows)
    reached = [_FAR] * (4 * count + 4)
    limit = _dive(rows, bounds, entry, exits)
    best: tuple[int, str, int] | None = None
    path: list[str] = []
    stack = [("", 0, entry, 0, 0)]
    while stack:
        letter, at, state, cost, depth = stack.pop()
        node = 4 * at + state
        # An equal cost that comes later has the greater audit; the dive's cost alone is no audit yet and may be met.
        if cost >= reached[node] or cost + bounds[at][state] > limit or (best and cost + bounds[at][state] >= best[0]):
            continue
        if not any(x in _REACH[state] for x in exits):
            continue
        reached[node] = cost
        if depth:
            del path[depth - 1 :]
            path.append(letter)
        if at == count and state in exits:
            best = (cost, "".join(path), state)
            limit = cost
        steps = children(rows[at], state) if at < count else []
        steps = [(s, at + 1, to, cost + c, depth + 1) for s, c, to in steps]
        steps.append(("I", at, _NEXT[state], cost + INSERT, depth + 1))
        steps.sort(key=lambda step: step[0], reverse=True)
        stack += steps
    return best


def edited(audit: str, turns: list[tuple[str, str]], state: int) -> list[tuple[str, str, str]]:
    """(role, text, letter) of what an audit leaves of the turns; the letters determine all roles."""
    out, at = [], 0
    for letter in audit:
        if letter == "I":
            out.append((_NEW_ROLE[state], "", letter))
            state = _NEXT[state]
            continue
        role, text = turns[at]
        at += 1
        if letter == "K":
            out.append((role, text, letter))
            state = _KEEP[state][role[:1]]
        elif letter == "R":
            out.append((_NEW_ROLE[state], text, letter))
            state = _NEXT[state]
    return out


class _Path:
    """The end of a way through the pieces so far: what it adds to the way it continues."""

    __slots__ = ("above", "audit", "cost", "depth", "turns")

    def __init__(self, above: _Path | None, cost: int, audit: str, turns: list[tuple[str, str, str]]):
        self.above, self.cost, self.audit, self.turns = above, cost, audit, turns
        self.depth = above.depth + 1 if above else 0


def _common(paths: list[_Path]) -> _Path:
    """The last path that all paths continue."""
    while any(p is not paths[0] for p in paths):
        deepest = max(p.depth for p in paths)
        paths = [p.above if p.depth == deepest else p for p in paths]
    return paths[0]


def _audit_from(path: _Path, root: _Path) -> str:
    parts = []
    while path is not root:
        parts.append(path.audit)
        path = path.above
    return "".join(reversed(parts))


class _Conversation:
    def __init__(self, conv_id):
        self.conv_id = conv_id
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.low = self.high = self.turn = self.before = None
        self.distinct, self.any, self.fresh = 0, False, set()
        self.rows: list[tuple[str, bool, int]] = []
        self.turns: list[tuple[str, str]] = []
        self.chars = 0
        self.audit: list[str] = []
        self.root = _Path(None, 0, "", [])
        self.paths: dict[int, _Path] = {START: self.root}

    def enter_turn(self, turn) -> None:
        """Called before the rows of a turn and the keys first seen in it."""
        if turn != self.turn:
            self.turn, self.fresh = turn, set()

    def add(self, turn, role: str, text: str, key: bytes) -> list[tuple[str, str, str]]:
        """Take the next row; gives the repaired turns that are now certain."""
        if turn is not None:
            if turn != self.high:
                self.distinct += 1
            self.low = turn if self.low is None else self.low
            self.high = turn
        initial = role[:1]
        if self.any and self.before + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.any, self.before = True, initial
        held = text.strip(BLANKS)
        first = key in self.fresh
        self.fresh.discard(key)
        must_go, penalty = True, 0
        if not held:
            self.blank += 1
        elif not first:
            self.duplicate += 1
        else:
            must_go = False
            if held[-1] not in ".!?":
                self.truncated, penalty = self.truncated + 1, TRUNCATED
        self.rows.append((initial, must_go, penalty))
        self.turns.append((role, "" if must_go else text))
        self.chars += len(self.turns[-1][1])
        if len(self.rows) < PIECE_ROWS and self.chars < PIECE_CHARS:
            return []
        self._advance(range(4))
        return self._certain(_common(list(self.paths.values())))

    def _advance(self, exits) -> None:
        """Continue the paths over the rows held: the best way to each exit, by (cost, audit)."""
        bounds = suffix_bounds(self.rows)
        found: dict[int, tuple[_Path, int, str, int]] = {}
        for entry, path in self.paths.items():
            for wanted in exits:
                got = search(self.rows, bounds, entry, wanted if isinstance(wanted, tuple) else (wanted,))
                if got is None:
                    continue
                cost, audit, state = got
                old = found.get(state)
                if old is None or self._before((path, path.cost + cost, audit), old):
                    found[state] = (path, path.cost + cost, audit, entry)
        self.paths = {
            state: _Path(path, cost, audit, edited(audit, self.turns, entry)) for state, (path, cost, audit, entry) in found.items()
        }
        self.rows, self.turns, self.chars = [], [], 0

    def _before(self, new: tuple, old: tuple) -> bool:
        if new[1] != old[1]:
            return new[1] < old[1]
        root = _common([new[0], old[0]])
        return _audit_from(new[0], root) + new[2] < _audit_from(old[0], root) + old[2]

    def _certain(self, end: _Path) -> list[tuple[str, str, str]]:
        way = []
        path = end
        while path is not self.root:
            way.append(path)
            path = path.above
        self.root = end
        out = []
        for path in reversed(way):
            self.audit.append(path.audit)
            out += path.turns
            path.turns, path.above = [], None
        return out

    def finish(self) -> tuple[list[tuple[str, str, str]], tuple]:
        """The last repaired turns, and (gaps, blank, duplicate, truncated, illegal, cost, audit)."""
        self._advance([ENDS])
        end = min(self.paths.values(), key=lambda p: p.cost)
        ends = [p for p in self.paths.values() if p.cost == end.cost]
        if len(ends) > 1:
            root = _common(ends)
            end = min(ends, key=lambda p: _audit_from(p, root))
        turns = self._certain(end)
        gaps = 0 if self.low is None else int(self.high - self.low) + 1 - self.distinct
        return turns, (gaps, self.blank, self.duplicate, self.truncated, self.illegal, end.cost, "".join(self.audit))


MEASURES = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def repair(spark: SparkSession, turns: DataFrame, dropped: Column | None = None) -> DataFrame:
    """Repaired conversations as a stream: their turns in order, then one row of measures each.

    Rows are (conv_id, role, text, edit) for a turn, where ``edit`` is K, R or I, and (conv_id, gaps, blank, duplicate,
    truncated, illegal, cost, audit) for a conversation, with ``edit`` null. Null roles and texts are one space. Rows
    are taken by (turn, role, text), nulls first; equal rows are copies, so all but one are duplicates. A role that is
    empty or begins with another letter than u, a or s cannot be kept. ``dropped`` marks rows that are not there but
    name their conversation; one without rows has zeros and an empty audit. Rows with a null id are one conversation.
    An empty table gives an empty result, and other columns are ignored.
    """
    gone = F.coalesce(dropped, F.lit(False)) if dropped is not None else F.lit(False)
    held = turns.select(
        "conv_id",
        "turn",
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
        gone.alias("gone"),
    )
    said = F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")
    rows = held.select(
        "conv_id",
        "turn",
        F.when(~F.col("gone"), F.col("role")).alias("role"),
        F.when(~F.col("gone"), F.col("text")).alias("text"),
        F.when(~F.col("gone"), F.unhex(F.md5(said))).alias("key"),
        F.lit(1).alias("kind"),
    )
    # Where each (role, text) of a conversation is first: combined before the shuffle, so copies cost nothing.
    first = F.min(F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn"))).alias("at")
    seen = rows.filter(F.col("key").isNotNull()).groupBy("conv_id", "key").agg(first)
    nothing = F.lit(None).cast("string")
    marks = seen.select(
        "conv_id", F.col("at.turn").alias("turn"), nothing.alias("role"), nothing.alias("text"), "key", F.lit(0).alias("kind")
    )
    count = B.partitions_for(turns)
    ordered = rows.union(marks).repartition(count, "conv_id").sortWithinPartitions("conv_id", "turn", "kind", "role", "text")

    id_kind = turns.schema["conv_id"].dataType.simpleString()
    measures = ", ".join(f"{m} long" for m in MEASURES)
    schema = f"conv_id {id_kind}, role string, text string, edit string, {measures}, audit string"

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current: _Conversation | None = None
        out = _Out()
        for batch in batches:
            out.id_type = batch.schema.field("conv_id").type
            columns = (batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "key", "kind"))
            for conv_id, turn, role, text, key, kind in zip(*columns, strict=True):
                if current is None or current.conv_id != conv_id:
                    if current is not None:
                        out.close(current)
                    current = _Conversation(conv_id)
                current.enter_turn(turn)
                if kind == 0:
                    current.fresh.add(key)
                elif key is not None:
                    out.take(conv_id, current.add(turn, role, text, key))
                if len(out.ids) >= EMITTED_ROWS or out.chars >= PIECE_CHARS:
                    yield out.batch()
        if current is not None:
            out.close(current)
            yield out.batch()

    return ordered.mapInArrow(scan, schema)


class _Out:
    """Rows to give out."""

    def __init__(self):
        self.id_type = pa.int64()
        self._clear()

    def _clear(self) -> None:
        self.ids, self.said, self.measured, self.chars = [], [], [], 0

    def take(self, conv_id, turns: list[tuple[str, str, str]]) -> None:
        self.ids += [conv_id] * len(turns)
        self.said += turns
        self.measured += [(None,) * (len(MEASURES) + 1)] * len(turns)
        self.chars += sum(len(t) for _, t, _ in turns)

    def close(self, conversation: _Conversation) -> None:
        turns, measured = conversation.finish()
        self.take(conversation.conv_id, turns)
        self.ids.append(conversation.conv_id)
        self.said.append((None, None, None))
        self.measured.append(measured)

    def batch(self) -> pa.RecordBatch:
        columns = {"conv_id": pa.array(self.ids, self.id_type)}
        for i, name in enumerate(("role", "text", "edit")):
            columns[name] = pa.array([s[i] for s in self.said], pa.string())
        for i, name in enumerate(MEASURES):
            columns[name] = pa.array([m[i] for m in self.measured], pa.int64())
        columns["audit"] = pa.array([m[-1] for m in self.measured], pa.string())
        self._clear()
        return pa.RecordBatch.from_pydict(columns)


def digests(repaired: DataFrame) -> DataFrame:
    """One row a conversation: its measures, audit and the sha256 of its repaired ``role:text`` lines.

    Reads the output of ``repair`` in the order in which its tasks give it, without a shuffle.
    """
    schema = f"conv_id {repaired.schema['conv_id'].dataType.simpleString()}, "
    schema += ", ".join(f"{m} long" for m in MEASURES) + ", audit string, repaired_sha256 string"

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest, any_turn = hashlib.sha256(), False
        for batch in batches:
            ends, done = [], []
            columns = (batch.column(c).to_pylist() for c in ("role", "text", "edit"))
            for i, (role, text, edit) in enumerate(zip(*columns, strict=True)):
                if edit is None:
                    ends.append(i)
                    done.append(digest.hexdigest())
                    digest, any_turn = hashlib.sha256(), False
                else:
                    digest.update(f"{chr(10) if any_turn else ''}{role}:{text}".encode())
                    any_turn = True
            closed = batch.take(pa.array(ends, pa.int64())).select(["conv_id", *MEASURES, "audit"])
            yield pa.RecordBatch.from_arrays([*closed.columns, pa.array(done, pa.string())], [*closed.schema.names, "repaired_sha256"])

    return repaired.mapInArrow(scan, schema)


def damage(turns: DataFrame) -> DataFrame:
    """Planted faults, by crc32 of ``conv_id:turn`` modulo 20: 0 drops a row, 1 empties its text, 2 removes its ``.!?``,
    3 repeats it, 4 makes it the user's. Nulls are one space. Dropped rows stay with ``dropped`` set."""
    space = F.lit(" ")
    name = [F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")]
    fault = F.crc32(F.concat(name[0], F.lit(":"), name[1])) % 20
    role, text = F.coalesce("role", space), F.coalesce("text", space)
    rows = turns.select(
        "conv_id",
        "turn",
        F.when(fault == 4, "user").otherwise(role).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        (fault == 0).alias("dropped"),
        F.explode(F.array_repeat(F.lit(1), F.when(fault == 3, 2).otherwise(1))).alias("_copy"),
    )
    return rows.drop("_copy")
