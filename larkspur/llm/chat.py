"""Chat formatting by schema fingerprints.

A record is a JSON object in one of several layouts. Its nested field paths (array steps
as ``[]``), cut down to the paths that any mapping names, are hashed; the hash selects a
declarative mapping that turns the record into canonical ``(role, text)`` turns. Turns are
rendered with control strings; control strings inside roles and texts are escaped with a
backslash, which ``read_back`` undoes exactly.

* null roles and texts count as empty; a text that is a list of parts is the parts' texts, one
  after another; other values are their JSON; a lone surrogate becomes U+FFFD;
* an item of a list of turns that is no object is a turn without role, and an empty list has no turns: one row
  with a null ``segment`` and ``turn``;
* a record with the fields of several layouts counts as the first of them in ``MAPPINGS``;
* a record that is null, no object, nested too deeply to read or of no known layout gives one row
  with a null ``layout``, ``segment`` and ``turn``; ``read_back`` answers a conversation without turns with zeros;
* a conversation's digests run over its turns in order, so one conversation is one task's work,
  streamed, whatever its length;
* turns of a conversation keep the order of ``turn`` (null first), then of their rendered
  text, so repeated rows stay repeated and ties have one order;
* other fields of a record are ignored unless they share a mapping's path.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURN, TEXT, DONE = "<|turn|>", "<|text|>", "<|done|>"
#: Control strings of this template and of common others; the same pattern is used in the SQL counterpart.
CONTROL = r"([<\[])(\|(?:turn|text|done|endoftext|im_start|im_end)\|>|/?s>|</?SYS>>|/?INST\])"
_CONTROL = re.compile(CONTROL)
_ESCAPED = re.compile(r"\\(\\?)")
_SURROGATE = re.compile("[\ud800-\udfff]")
_SEGMENT = re.compile(r"<\|turn\|>(.*?)<\|text\|>(.*?)<\|done\|>", re.S)


def escape(text: str) -> str:
    return _CONTROL.sub(r"\1\\\2", text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


@dataclass(frozen=True)
class Mapping:
    """How one layout becomes turns. Either ``turns`` names a list with ``role`` and ``text`` in its items, or
    ``parts`` lists (role, paths): the texts at those paths, joined by a blank line, make one turn."""

    name: str
    required: tuple[str, ...]
    optional: tuple[str, ...] = ()
    turns: str | None = None
    role: str = "role"
    text: str = "text"
    roles: dict[str, str] = field(default_factory=dict)
    parts: tuple[tuple[str, tuple[str, ...]], ...] = ()
    single: bool = False  # the record itself is one turn


MAPPINGS = (
    Mapping("turn_row", ("role", "text"), single=True),
    Mapping("messages", ("messages[].role", "messages[].content"), turns="messages", text="content"),
    Mapping("conversations", ("conversations[].from", "conversations[].value"), turns="conversations", role="from", text="value", roles={"human": "user", "gpt": "assistant"}),
    Mapping("prompt_completion", ("prompt", "completion"), ("system",), parts=(("system", ("system",)), ("user", ("prompt",)), ("assistant", ("completion",)))),
    Mapping("prompt_response", ("prompt", "response"), ("system",), parts=(("system", ("system",)), ("user", ("prompt",)), ("assistant", ("response",)))),
    Mapping("instruction", ("instruction", "output"), ("input", "system"), parts=(("system", ("system",)), ("user", ("instruction", "input")), ("assistant", ("output",)))),
)


def field_paths(value: object, prefix: str = "") -> set[str]:
    """Paths of all leaves of a JSON value."""
    if isinstance(value, dict):
        return {p for k, v in value.items() for p in field_paths(v, f"{prefix}.{k}" if prefix else k)}
    if isinstance(value, list):
        return {p for v in value for p in field_paths(v, f"{prefix}[]")} or {f"{prefix}[]"}
    return {prefix}


def fingerprint(paths: set[str]) -> str:
    return hashlib.sha1("\n".join(sorted(paths)).encode()).hexdigest()[:16]


def layout_table(mappings: tuple[Mapping, ...]) -> tuple[set[str], dict[str, Mapping]]:
    """All paths that mappings name, and the mapping of each fingerprint."""
    known = {p for m in mappings for p in (*m.required, *m.optional, *([f"{m.turns}[]"] if m.turns else []))}
    table = {}
    for m in mappings:
        items = (f"{m.turns}[]",) if m.turns else ()
        optional = (*m.optional, *items)
        for n in range(len(optional) + 1):
            for extra in itertools.combinations(optional, n):
                table.setdefault(fingerprint({*m.required, *extra}), m)
        if m.turns:
            table.setdefault(fingerprint({*items}), m)
    return known, table


def known_paths(value: object, known: set[str]) -> set[str]:
    """The paths of a record, each cut down to the longest known path that it starts with."""
    out = set()
    for path in field_paths(value):
        while path and path not in known:
            path = path[:-2] if path.endswith("[]") else path.rpartition(".")[0]
        out.add(path)
    return out - {""}


def layout_of(value: object, known: set[str], table: dict[str, Mapping], mappings: tuple[Mapping, ...]) -> Mapping | None:
    """The mapping of a record's fingerprint; with the fields of several, the first whose fields are all there."""
    if not isinstance(value, dict):
        return None
    paths = known_paths(value, known)
    return table.get(fingerprint(paths)) or next((m for m in mappings if paths.issuperset(m.required)), None)


def _string(value: object) -> str:
    if isinstance(value, list) and all(isinstance(x, str) or isinstance(x, dict) and isinstance(x.get("text"), str | None) for x in value):
        value = "".join(x if isinstance(x, str) else x.get("text") or "" for x in value)
    text = "" if value is None else value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)
    return _SURROGATE.sub("\ufffd", text)


def turns_of(record: object, mapping: Mapping) -> list[tuple[str, str]]:
    if mapping.single:
        return [(_string(record.get("role")), _string(record.get("text")))]
    if mapping.turns:
        out = []
        for x in record[mapping.turns] or ():
            if not isinstance(x, dict):
                out.append(("", _string(x)))
                continue
            role = _string(x.get(mapping.role))
            out.append((mapping.roles.get(role, role), _string(x.get(mapping.text))))
        return out
    out = []
    for role, paths in mapping.parts:
        found = [_string(record[p]) for p in paths if record.get(p) is not None]
        if found or role != "system":
            out.append((role, "\n\n".join(x for x in found if x)))
    return out


def render(role: str, text: str) -> tuple[str, int, int]:
    """A turn's segment and where its text stands in it."""
    head = f"{TURN}{escape(role)}{TEXT}"
    body = escape(text)
    return f"{head}{body}{DONE}", len(head), len(head) + len(body)


def format_records(records: DataFrame, conv: str, order: str, record: Column, mappings: tuple[Mapping, ...] = MAPPINGS) -> DataFrame:
    """(conv_id, record_no, turn, layout, segment, loss_start, loss_end): one row for each turn; the loss mask
    covers code points ``loss_start`` to ``loss_end`` of an assistant's segment and nothing of others."""

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, table = layout_table(mappings)
        names = ["conv_id", "record_no", "turn", "layout", "segment", "loss_start", "loss_end"]
        types = [pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64()]
        for batch in batches:
            rows: list[list] = [[] for _ in names]
            for c, o, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                try:
                    value = json.loads(raw) if raw is not None else None
                    found = layout_of(value, known, table, mappings)
                except (ValueError, RecursionError):
                    found = None
                if found is None:
                    made = [(c, o, None, None, None, None, None)]
                else:
                    made = []
                    for k, (role, text) in enumerate(turns_of(value, found)):
                        segment, a, b = render(role, text)
                        under = role == "assistant"
                        made.append((c, o, k, found.name, segment, a if under else 0, b if under else 0))
                    made = made or [(c, o, None, found.name, None, None, None)]
                for row in made:
                    for column, x in zip(rows, row, strict=True):
                        column.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(rows, types, strict=True)], names)

    picked = records.select(F.col(conv).cast("long").alias("conv_id"), F.col(order).cast("long").alias("record_no"), record.alias("record"))
    return picked.mapInArrow(convert, "conv_id long, record_no long, turn int, layout string, segment string, loss_start long, loss_end long")


def read_back(segments: DataFrame) -> DataFrame:
    """Parse formatted conversations: (conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars).

    Segments are sorted by conversation and streamed through running digests, so a conversation
    of any length needs a bounded amount of memory.
    """
    dealt = segments.repartition("conv_id").sortWithinPartitions("conv_id", "record_no", "turn", "segment")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        now: list | None = None

        def close(s: list) -> tuple:
            return (s[0], s[1], s[2].hexdigest(), s[3], s[4].hexdigest(), s[5])

        for batch in batches:
            done = []
            for c, segment, a, b in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if now is None or now[0] != c:
                    if now is not None:
                        done.append(close(now))
                    now = [c, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                if segment is None:
                    continue
                for role, text in _SEGMENT.findall(segment):
                    now[1] += 1
                    now[2].update(f"{unescape(role)}\n{unescape(text)}\n".encode())
                under = unescape(segment[a:b])
                now[3] += len(under)
                now[4].update(under.encode())
                now[5] += len(segment)
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*done, strict=True) if done else [[]] * 6, types, strict=True)], names)
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(close(now), types, strict=True)], names)

    return dealt.select("conv_id", "segment", "loss_start", "loss_end").mapInArrow(digest, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def conversations(segments: DataFrame) -> DataFrame:
    """(conv_id, formatted): the whole formatted text of each conversation, for conversations that fit a row."""
    rows = segments.where(F.col("segment").isNotNull()).groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("record_no", "turn", "segment"))).alias("s"))
    return rows.select("conv_id", F.array_join(F.col("s.segment"), "").alias("formatted"))
