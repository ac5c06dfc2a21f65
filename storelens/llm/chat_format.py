"""Conversations of several record layouts as canonical turns, and their text for training with a mask of what to learn."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce
from itertools import combinations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StringType, StructType

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
LEARNED_ROLE = "assistant"
# A part of a formatted conversation ends with the turn that takes it to so many characters.
PART_CHARS = 1 << 20


@dataclass(frozen=True)
class Turn:
    """A turn, or one for each element of the array at path ``each``; paths within an element are relative to it.

    The role is ``role`` or stands at ``role_path``. Of several text paths those with a value are joined by an empty line.
    """

    text: tuple[str, ...]
    role: str | None = None
    role_path: str | None = None
    each: str | None = None

    def paths(self) -> set[str]:
        inner = set(self.text) | ({self.role_path} if self.role_path else set())
        return {f"{self.each}[].{path}" for path in inner} if self.each else inner


@dataclass(frozen=True)
class Layout:
    """A mapping from the fields of a record to turns; ``optional`` names paths a record of it may lack."""

    name: str
    turns: tuple[Turn, ...]
    optional: frozenset[str] = frozenset()
    roles: dict[str, str] = field(default_factory=dict, hash=False)

    def paths(self) -> set[str]:
        return set().union(*(turn.paths() for turn in self.turns))

    def fingerprints(self) -> list[str]:
        """One for each set of optional paths that may be there."""
        needed = self.paths() - self.optional
        return [
            fingerprint_of(needed | set(some))
            for size in range(len(self.optional) + 1) for some in combinations(sorted(self.optional), size)
        ]


ROLE_NAMES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}
LAYOUTS = (
    Layout("message_row", (Turn(("text",), role_path="role"),), frozenset({"role"})),
    Layout("prompt_completion", (Turn(("system",), "system"), Turn(("prompt",), "user"), Turn(("completion",), "assistant")), frozenset({"system"})),
    Layout("prompt_response", (Turn(("system",), "system"), Turn(("prompt",), "user"), Turn(("response",), "assistant")), frozenset({"system"})),
    Layout("instruction", (Turn(("system",), "system"), Turn(("instruction", "input"), "user"), Turn(("output",), "assistant")), frozenset({"system", "input"})),
    Layout("question_answer", (Turn(("question",), "user"), Turn(("answer",), "assistant"))),
    Layout("messages", (Turn(("content",), role_path="role", each="messages"),), frozenset({"messages[].content"}), ROLE_NAMES),
    Layout("conversations", (Turn(("value",), role_path="from", each="conversations"),), frozenset({"conversations[].value"}), ROLE_NAMES),
    Layout("nested_messages", (Turn(("message.content",), role_path="message.role", each="data.turns"),), frozenset(), ROLE_NAMES),
)


def fingerprint_of(paths: set[str]) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()


def _at(value: Column, kind: DataType, steps: list[str]) -> tuple[Column, DataType] | None:
    """The field some steps below a struct, or None where the schema has no such field."""
    for step in steps:
        if not isinstance(kind, StructType) or step not in kind.names:
            return None
        value, kind = value.getField(step), kind[step].dataType
    return value, kind


def _holds(value: Column, kind: DataType, path: str) -> Column | None:
    """Whether a record has a value at a path; within an array, whether any element has."""
    head, array, rest = path.partition("[]")
    found = _at(value, kind, [s for s in head.split(".") if s])
    if found is None:
        return None
    value, kind = found
    if not array:
        return None if isinstance(kind, (ArrayType, StructType)) else value.isNotNull()
    if not isinstance(kind, ArrayType) or _holds(F.lit(None), kind.elementType, rest.lstrip(".")) is None:
        return None
    return F.coalesce(F.exists(value, lambda x: _holds(x, kind.elementType, rest.lstrip("."))), F.lit(False))


def _text(value: Column, kind: DataType, paths: tuple[str, ...]) -> Column:
    found = [_at(value, kind, path.split(".")) for path in paths]
    texts = [f[0].cast("string") for f in found if f is not None and not isinstance(f[1], (ArrayType, StructType))]
    return F.concat_ws("\n\n", *texts) if texts else F.lit("")


def _turns(record: Column, kind: StructType, layout: Layout) -> Column:
    """The turns of a record of this layout, as an array of role and text."""
    def turn(value: Column, below: DataType, spec: Turn) -> Column:
        role = F.lit(spec.role) if spec.role is not None else _text(value, below, (spec.role_path,))
        for name, canonical in layout.roles.items():
            role = F.when(role == name, F.lit(canonical)).otherwise(role)
        return F.struct(role.alias("role"), _text(value, below, spec.text).alias("text"))

    parts = []
    for spec in layout.turns:
        if spec.each:
            found = _at(record, kind, spec.each.split("."))
            parts.append(F.transform(found[0], lambda x: turn(x, found[1].elementType, spec)))  # noqa: B023
        else:
            one = F.array(turn(record, kind, spec))
            held = [h for h in (_holds(record, kind, path) for path in spec.paths() & layout.optional) if h is not None]
            if spec.paths() <= layout.optional:  # a turn whose fields all lack is no turn
                empty = F.array().cast("array<struct<role: string, text: string>>")
                one = F.when(reduce(Column.__or__, held), one).otherwise(empty) if held else empty
            parts.append(one)
    return F.concat(*parts)


def canonical(records: DataFrame, layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """``records`` with the columns fingerprint_, layout_ and turns_ (array of role, text).

    The fingerprint is the hash of the sorted paths that hold a value, of those that any layout names; other fields do not
    count, ``[]`` stands for the elements of an array, and a field of another shape than its layout's is another path. A
    record whose fingerprint belongs to no layout has NULL as layout_ and turns_; ``unknown_layouts`` lists them. A missing text
    or role is empty text. Two layouts with one fingerprint are an error.
    """
    known = sorted(set().union(*(layout.paths() for layout in layouts)))
    chosen: dict[str, Layout] = {}
    for layout in layouts:
        for mark in layout.fingerprints():
            if chosen.setdefault(mark, layout) is not layout:
                raise ValueError(f"layouts {chosen[mark].name} and {layout.name} share a fingerprint")
    kind = records.schema
    # No top-level dots to parse: a struct of all columns is walked by field.
    record = F.struct(*[F.col(f"`{name}`") for name in records.columns])
    held = [(path, _holds(record, kind, path)) for path in known]
    present = [F.when(there, F.lit(path)) for path, there in held if there is not None]
    paths = F.concat_ws("\n", *present) if present else F.lit("")
    possible = {path for path, there in held if there is not None}
    usable = [layout for layout in layouts if layout.paths() - layout.optional <= possible]
    marked = records.withColumn("paths_", paths).withColumn("fingerprint_", F.sha2(F.col("paths_").cast("binary"), 256))
    name, turns = F.lit(None).cast("string"), F.lit(None).cast("array<struct<role: string, text: string>>")
    for layout in usable:
        mine = F.col("fingerprint_").isin(layout.fingerprints())
        name = F.when(mine, F.lit(layout.name)).otherwise(name)
        turns = F.when(mine, _turns(record, kind, layout)).otherwise(turns)
    return marked.withColumns({"layout_": name, "turns_": turns})


def unknown_layouts(records: DataFrame, layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """What a new layout is needed for: fingerprint, its paths and the number of records."""
    found = canonical(records, layouts).where("layout_ is null")
    return found.groupBy(F.col("fingerprint_").alias("fingerprint"), F.col("paths_").alias("paths")).agg(F.count("*").alias("records"))


# A backslash more between the two characters every control string begins with, however many there are already: no text
# holds a control string then, and taking one away gives the text back.
_MARK, _MARKED = r"<(\\*)\|", r"<\\$1|"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(_MARK), F.lit(_MARKED))


def escaped_role(role: Column) -> Column:
    """A role stands in one line, so backslash and line feed are spelled out first."""
    return escaped(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def unescape(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


_PART = "conv_ {kind}, part long, text string, loss array<struct<start: long, stop: long>>"


def format_chats(
    records: DataFrame, id_col: str = "conv_id", order_col: str = "turn", layouts: tuple[Layout, ...] = LAYOUTS,
) -> DataFrame:
    """Formatted conversations in parts: id, part (from 0), text, loss (spans of ``text`` to learn, in code points).

    Records of one id are one conversation, by ``order_col`` (NULL first), then by place in the record, role and text. A turn is
    ``<|im_start|>role``, line feed, text, ``<|im_end|>``, line feed; texts and roles are escaped, see ``read_back``. The span
    of an assistant turn is its escaped text. Records of no known layout have no turns.

    Turns are formatted where they are read and moved once. A conversation is written from a sorted stream, in parts of about
    ``PART_CHARS`` characters which hold whole turns, so a task never holds more of it than a part. Parts of a
    conversation stand one behind the other in one partition. NULL is an id like any other; NULL texts are empty; repeated records
    are repeated turns; other columns are ignored. No records in, no rows out.
    """
    named = records.columns
    needed = {path.split(".")[0].split("[")[0] for layout in layouts for path in layout.paths()}
    taken = [F.col(f"`{name}`") for name in named if name in needed and name not in (id_col, order_col)]
    found = canonical(records.select(F.col(id_col).alias("conv_"), F.col(order_col).alias("order_"), *taken), layouts)
    turns = found.select("conv_", "order_", F.posexplode("turns_").alias("place_", "turn_")).select(
        "conv_", "order_", "place_", "turn_.role", "turn_.text")
    head = F.concat(F.lit(OPEN), escaped_role(F.col("role")), F.lit("\n"))
    body = escaped(F.col("text"))
    pieces = turns.select(
        "conv_", "order_", "place_", F.concat(head, body, F.lit(f"{CLOSE}\n")).alias("piece_"),
        F.when(F.col("role") == LEARNED_ROLE, F.char_length(head)).alias("from_"),
    )
    ordered = pieces.repartition("conv_").sortWithinPartitions("conv_", "order_", "place_", "piece_")
    kind = ordered.schema["conv_"].dataType.simpleString()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, part, texts, spans, chars, begun = None, 0, [], [], 0, False
        for batch in batches:
            rows = zip(*(batch.column(name).to_pylist() for name in ("conv_", "piece_", "from_")))
            for own, piece, start in rows:
                if begun and (own != conv or chars >= PART_CHARS):
                    yield _part(batch.schema.field("conv_").type, conv, part, texts, spans)
                    part, texts, spans, chars = part + 1, [], [], 0
                if not begun or own != conv:
                    conv, part, begun = own, 0, True
                if start is not None:
                    spans.append({"start": chars + start, "stop": chars + len(piece) - len(CLOSE) - 1})
                texts.append(piece)
                chars += len(piece)
        if begun:
            yield _part(batch.schema.field("conv_").type, conv, part, texts, spans)

    return ordered.mapInArrow(write, _PART.format(kind=kind)).withColumnRenamed("conv_", id_col)


def _part(kind: pa.DataType, conv: object, part: int, texts: list[str], spans: list[dict]) -> pa.RecordBatch:
    span = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
    return pa.RecordBatch.from_arrays(
        [pa.array([conv], kind), pa.array([part], pa.int64()), pa.array(["".join(texts)], pa.string()), pa.array([spans], span)],
        names=["conv_", "part", "text", "loss"])


_TURN = re.compile(rf"{re.escape(OPEN)}([^\n]*)\n(.*?){re.escape(CLOSE)}\n", re.S)


def read_back(text: str) -> list[tuple[str, str]]:
    """Roles and texts of a formatted conversation or part, as they were before they were escaped."""
    return [(unescape_role(role), unescape(body)) for role, body in _TURN.findall(text)]


class _Digest:
    """What is read back of one conversation."""

    def __init__(self):
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.formatted_chars = 0

    def add(self, text: str, spans: list[dict]) -> None:
        for role, body in read_back(text):
            self.turns.update(f"{role}\n{body}\n".encode())
            self.n_turns += 1
        for span in spans:
            learned = unescape(text[span["start"]:span["stop"]])
            self.loss.update(learned.encode())
            self.loss_chars += len(learned)
        self.formatted_chars += len(text)

    def row(self) -> tuple:
        return self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.formatted_chars


def chat_digests(parts: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """What the output of ``format_chats`` says, read from its text and spans: one row per conversation.

    id, n_turns, turns_sha256 (role, line feed, text, line feed per turn), loss_chars and loss_sha256 (code points and digest of
    the unescaped text under the spans) and formatted_chars. Takes the parts as that function returns them, in their order.
    """
    kind = parts.schema[id_col].dataType.simpleString()
    names = ["conv_", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, digest, kind_ = None, None, None
        for batch in batches:
            kind_ = batch.schema.field("conv_").type
            done = []
            for own, part, text, spans in zip(*(batch.column(n).to_pylist() for n in ("conv_", "part", "text", "loss"))):
                if part == 0:
                    if digest is not None:
                        done.append((conv, *digest.row()))
                    conv, digest = own, _Digest()
                digest.add(text, spans)
            if done:
                yield _digests(done, kind_, names)
        if digest is not None:
            yield _digests([(conv, *digest.row())], kind_, names)

    read_parts = parts.select(F.col(id_col).alias("conv_"), "part", "text", "loss")
    found = read_parts.mapInArrow(
        read, f"conv_ {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
    return found.withColumnRenamed("conv_", id_col)


def _digests(rows: list[tuple], kind: pa.DataType, names: list[str]) -> pa.RecordBatch:
    kinds = [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(column, k) for column, k in zip(zip(*rows), kinds)], names=names)
