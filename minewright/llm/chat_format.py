"""Operator 8: chat formatting with a grammar round trip.

A conversation is rendered turn by turn. The rendered turn is parsed again by a deterministic parser; when what comes back
is not what went in, the text is rendered with its control strings escaped. All results are read from the parsed output.

Grammar (fixed values of this template):

    user       <s>[INST] text [/INST]
    assistant  ' ' text </s>
    others     <<TURN role>> text <</TURN>>

An escaped text has a backslash before every backslash and control string. Turns are sorted within hash partitions and
flow through the task; a conversation of any length needs memory for one turn.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CONTROL = ("<s>", "</s>", "[INST]", "[/INST]", "<<TURN", "<</TURN>>", ">>")
_ESCAPE = re.compile(r"\\|" + "|".join(re.escape(c) for c in CONTROL))
_UNESCAPE = re.compile(r"\\(.)", re.DOTALL)
_USER, _USER_END = "<s>[INST] ", " [/INST]"
_REPLY, _REPLY_END = " ", "</s>"
_OTHER, _ROLE_END, _OTHER_END = "<<TURN ", ">> ", " <</TURN>>"
_ENDS = {end: re.compile(r"\\.|" + re.escape(end), re.DOTALL) for end in (_USER_END, _REPLY_END, _ROLE_END, _OTHER_END)}


def escape(text: str) -> str:
    return _ESCAPE.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1", text)


def render_turn(role: str, text: str) -> str:
    if role == "user":
        return _USER + text + _USER_END
    if role == "assistant":
        return _REPLY + text + _REPLY_END
    return _OTHER + escape(role) + _ROLE_END + text + _OTHER_END


def _until(source: str, at: int, end: str) -> tuple[str, int]:
    for found in _ENDS[end].finditer(source, at):
        if found[0] == end:
            return source[at : found.start()], found.end()
    raise ValueError(f"no {end!r} after {at}")


def parse_turn(source: str, at: int) -> tuple[str, str, int]:
    """Role and text of the turn at ``at``, and where the next one begins; ValueError outside the grammar."""
    if source.startswith(_USER, at):
        body, to = _until(source, at + len(_USER), _USER_END)
        return "user", unescape(body), to
    if source.startswith(_OTHER, at):
        role, at = _until(source, at + len(_OTHER), _ROLE_END)
        body, to = _until(source, at, _OTHER_END)
        return unescape(role), unescape(body), to
    if source.startswith(_REPLY, at):
        body, to = _until(source, at + len(_REPLY), _REPLY_END)
        return "assistant", unescape(body), to
    raise ValueError(f"no turn at {at}")


def format_turn(role: str, text: str) -> tuple[str, str, str]:
    """Rendered turn with the role and text that the parser reads from it; escaped only when it must be."""
    for body in (text, escape(text)):
        rendered = render_turn(role, body)
        try:
            back = parse_turn(rendered, 0)
        except ValueError:
            continue
        if back == (role, text, len(rendered)):
            return rendered, back[0], back[1]
    raise ValueError(f"turn of role {role!r} does not survive the round trip")


class _Digest:
    def __init__(self, conv_id):
        self.conv_id, self.turns, self.loss, self.formatted = conv_id, 0, 0, 0
        self.turn_hash, self.loss_hash = hashlib.sha256(), hashlib.sha256()

    def add(self, role: str, text: str) -> None:
        rendered, role, text = format_turn(role, text)
        self.turns += 1
        self.formatted += len(rendered)
        self.turn_hash.update(f"{role}\n{text}\n".encode())
        if role == "assistant":
            self.loss += len(text)
            self.loss_hash.update(text.encode())

    def row(self) -> tuple:
        return (self.conv_id, self.turns, self.turn_hash.hexdigest(), self.loss, self.loss_hash.hexdigest(), self.formatted)


def format_rows(turns: DataFrame) -> DataFrame:
    """Every turn with its ``rendered`` text; concatenated in turn order they are the conversation. No shuffle."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            roles, texts = (batch.column(c).to_pylist() for c in ("role", "text"))
            rendered = [format_turn(r or "", t or "")[0] for r, t in zip(roles, texts, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rendered, pa.string())], names=[*names, "rendered"])

    rows = turns.select("conv_id", "turn", "role", "text")
    names = rows.columns
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema) + ", rendered string"
    return rows.mapInArrow(scan, schema)


def digest_conversations(spark: SparkSession, turns: DataFrame) -> DataFrame:
    """Per conversation: n_turns, turns_sha256, loss_chars, loss_sha256 and formatted_chars, read back from the output.

    The loss covers assistant texts. Turns go by (turn, role, text), nulls first; repeated rows are turns of their own.
    Null texts and roles are empty; rows with a null ``conv_id`` are one conversation. An empty table gives an empty
    result; other columns are ignored.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current: _Digest | None = None
        for batch in batches:
            done = []
            columns = (batch.column(c).to_pylist() for c in ("conv_id", "role", "text"))
            for conv_id, role, text in zip(*columns, strict=True):
                if current is None or current.conv_id != conv_id:
                    if current is not None:
                        done.append(current.row())
                    current = _Digest(conv_id)
                current.add(role or "", text or "")
            yield _rows(done)
        if current is not None:
            yield _rows([current.row()])

    kind = turns.schema["conv_id"].dataType.simpleString()
    id_type = pa.int64() if kind == "bigint" else pa.int32() if kind == "int" else pa.string()
    types = [id_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def _rows(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=names)

    count = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = turns.select("conv_id", "turn", "role", "text").repartition(count, "conv_id")
    ordered = rows.sortWithinPartitions("conv_id", "turn", "role", "text")
    schema = f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return ordered.mapInArrow(scan, schema)
