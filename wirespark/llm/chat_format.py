"""Conversations as marked text, proved by reading the text back with the template's grammar."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Characters of a piece of a conversation from which the next turn begins a new piece.
PIECE_CHARS = 8192
ESCAPE = "\\"

_PIECES = "conv_id bigint, formatted string, n_turns int, loss_starts array<int>, loss_ends array<int>"
_STORED = f"{_PIECES}, piece bigint"
_DIGESTS = (
    "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, "
    "loss_sha256 string, formatted_chars bigint"
)


class GrammarError(ValueError):
    """The text is not a sequence of turns."""


class Turn(NamedTuple):
    role: str
    text: str


class Parsed(NamedTuple):
    turn: Turn
    #: Where the turn's content stands, as it is written (escapes included).
    start: int
    end: int


@dataclass(frozen=True)
class Template:
    """Control strings around the turns of each role.

    A conversation is turn after turn; a turn is its role's first control string, the text and
    the second one. Turns of a role without strings of its own take those of ``other``, and the
    role stands on a line before the text. Inside a turn no control string may stand: an
    ``ESCAPE`` goes behind its first character, and what looks escaped already gets one more, so
    that taking one away gives the text back. Turns of ``loss_role`` are under the loss mask.

    Every control string must begin with a character that is nowhere else in any of them, and
    none may begin another. Then occurrences never overlap, a reader needs no look-ahead, and a
    text reads back once it is escaped.
    """

    roles: dict[str, tuple[str, str]] = field(
        default_factory=lambda: {
            "system": ("[SYS]", "[/SYS]"),
            "user": ("[INST]", "[/INST]"),
            "assistant": ("<s>", "</s>"),
        }
    )
    other: tuple[str, str] = ("[ROLE]", "[/ROLE]")
    loss_role: str = "assistant"

    def __post_init__(self) -> None:
        pairs = [*self.roles.values(), self.other]
        strings = sorted({s for pair in pairs for s in pair})
        if len({p[0] for p in pairs} | {p[1] for p in pairs}) < len({p[1] for p in pairs}) + len(pairs):
            raise ValueError("every role needs a first control string of its own")
        if any(a != b and b.startswith(a) for a in strings for b in strings):
            raise ValueError("no control string may begin another")
        first, inner = {s[:1] for s in strings}, {c for s in strings for c in s[1:]}
        if any(len(s) < 2 for s in strings) or first & inner or ESCAPE in first | inner:
            raise ValueError("a control string needs a first character that is nowhere else in them")
        if self.loss_role not in self.roles:
            raise ValueError("the role under the loss needs control strings of its own")

    @property
    def readers(self) -> tuple[re.Pattern, re.Pattern, re.Pattern]:
        """What finds control strings, these with escapes or without, and these with escapes."""
        strings = {s for pair in [*self.roles.values(), self.other] for s in pair}

        def pattern(between: str) -> re.Pattern:
            parts = (re.escape(s[0]) + between + re.escape(s[1:]) for s in sorted(strings))
            return re.compile("|".join(parts))

        slash = re.escape(ESCAPE)
        return pattern(""), pattern(f"{slash}*"), pattern(f"{slash}+")


class Formatter:
    """Writes and reads texts of a template."""

    def __init__(self, template: Template):
        self.template = template
        self.control, self.escapable, self.marked = template.readers
        self.opens = {begin: (role, end) for role, (begin, end) in template.roles.items()}
        self.opens[template.other[0]] = (None, template.other[1])

    def escaped(self, text: str) -> str:
        return self.escapable.sub(lambda m: m[0][0] + ESCAPE + m[0][1:], text)

    def unescaped(self, text: str) -> str:
        return self.marked.sub(lambda m: m[0][0] + m[0][2:], text)

    def parsed(self, formatted: str) -> Iterator[Parsed]:
        """The turns of a formatted text; at each point the next control string decides."""
        at = 0
        while at < len(formatted):
            begin = self.control.match(formatted, at)
            if not begin or begin[0] not in self.opens:
                raise GrammarError(f"no turn begins at {at}")
            role, close = self.opens[begin[0]]
            end = self.control.search(formatted, begin.end())
            if not end or end[0] != close:
                raise GrammarError(f"the turn at {at} does not end")
            text = self.unescaped(formatted[begin.end() : end.start()])
            if role is None:
                line, found, text = text.partition("\n")
                if not found:
                    raise GrammarError(f"the turn at {at} has no role")
                role = _read_line(line)
            yield Parsed(Turn(role, text), begin.end(), end.start())
            at = end.end()

    def rendered(self, turn: Turn) -> str:
        """One turn as it stands in the output: as it is, or escaped if that reads back otherwise."""
        begin, close = self.template.roles.get(turn.role, self.template.other)
        content = turn.text if turn.role in self.template.roles else f"{_line(turn.role)}\n{turn.text}"
        for written in (content, self.escaped(content)):
            formatted = begin + written + close
            if self._reads_back(formatted, [turn]):
                return formatted
        raise GrammarError(f"a turn of {turn.role!r} does not read back")

    def formatted(self, turns: list[Turn]) -> tuple[str, list[Parsed]]:
        """All turns as one text, and what is read back from it: these turns."""
        text = "".join(map(self.rendered, turns))
        found = list(self.parsed(text))
        if [p.turn for p in found] != turns:
            raise GrammarError("the turns do not read back")
        return text, found

    def _reads_back(self, formatted: str, turns: list[Turn]) -> bool:
        try:
            return [p.turn for p in self.parsed(formatted)] == turns
        except GrammarError:
            return False


def _line(role: str) -> str:
    """A role without line breaks."""
    return role.replace("\\", "\\\\").replace("\n", "\\n")


def _read_line(line: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], line)


def formatted(conversations: DataFrame, template: Template | None = None) -> DataFrame:
    """Conversations as text, in pieces of whole turns.

    ``conversations`` needs conv_id, turn, role and text; other columns are ignored. Turns are
    ordered by turn, then role and text, nulls first; repeated rows are repeated turns. A null
    role or text is empty, rows without a conv_id are one conversation, an empty table gives no
    rows. Each piece is parsed with the template's grammar and holds exactly the given turns.

    Rows are dealt by ranges of (conv_id, turn, role, beginning of the text), so a conversation
    with very many turns is spread over tasks, and a task holds a piece and not a conversation.

    Returns conv_id, piece (rising along a conversation, not gapless), formatted, n_turns and
    loss_starts, loss_ends: code points of ``formatted`` that count for the loss.
    """
    template = template or Template()
    rows = conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    rows = rows.withColumn("head", F.substring("text", 1, 32))
    order = ["conv_id", "turn", "role", "head"]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order, "text")

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        formatter, current, turns, size = Formatter(template), None, [], 0
        for batch in batches:
            out = []
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "role", "text")]
            for conv_id, role, text in zip(*columns, strict=True):
                if turns and (conv_id != current or size >= PIECE_CHARS):
                    out.append(_piece(formatter, current, turns))
                    turns, size = [], 0
                current = conv_id
                turns.append(Turn(role, text))
                size += len(text)
            if out:
                yield _batch(out, _PIECE_SCHEMA)
        if turns:
            yield _batch([_piece(formatter, current, turns)], _PIECE_SCHEMA)

    made = dealt.select("conv_id", "role", "text").mapInArrow(pieces, _PIECES)
    # Tasks hold rising ranges, so the ids of their rows rise along a conversation.
    return made.withColumn("piece", F.monotonically_increasing_id())


def _piece(formatter: Formatter, conv_id: int | None, turns: list[Turn]) -> tuple:
    text, found = formatter.formatted(turns)
    masked = [p for p in found if p.turn.role == formatter.template.loss_role]
    return conv_id, text, len(turns), [p.start for p in masked], [p.end for p in masked]


_PIECE_SCHEMA = pa.schema(
    {
        "conv_id": pa.int64(),
        "formatted": pa.string(),
        "n_turns": pa.int32(),
        "loss_starts": pa.list_(pa.int32()),
        "loss_ends": pa.list_(pa.int32()),
    }
)
_DIGEST_SCHEMA = pa.schema(
    {
        "conv_id": pa.int64(),
        "n_turns": pa.int64(),
        "turns_sha256": pa.string(),
        "loss_chars": pa.int64(),
        "loss_sha256": pa.string(),
        "formatted_chars": pa.int64(),
    }
)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(values, f.type) for values, f in zip(columns, schema, strict=True)], schema=schema
    )


def write_conversations(
    conversations: DataFrame, folder: str, template: Template | None = None
) -> None:
    """Write the pieces of all conversations as Parquet."""
    formatted(conversations, template).write.parquet(folder)


def read_conversations(spark: SparkSession, folder: str) -> DataFrame:
    """The pieces that ``write_conversations`` has written."""
    return spark.read.schema(_STORED).parquet(folder)


def digests(pieces: DataFrame, template: Template | None = None) -> DataFrame:
    """What stands in formatted conversations, from nothing but their text and loss mask.

    Returns one row per conversation: conv_id, n_turns, turns_sha256 (role, line break, text and
    line break of each turn), loss_chars and loss_sha256 (code points and digest of the text
    under the mask, unescaped), formatted_chars. A digest of a sequence is computed in order, so
    the pieces of one conversation pass through one task; it keeps one piece at a time.
    """
    template = template or Template()
    columns = ["conv_id", "formatted", "loss_starts", "loss_ends"]
    dealt = pieces.repartition("conv_id").sortWithinPartitions("conv_id", "piece")

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        formatter, current = Formatter(template), None
        for batch in batches:
            out = []
            values = [batch.column(c).to_pylist() for c in columns]
            for conv_id, text, starts, ends in zip(*values, strict=True):
                if current is None or conv_id != current.conv_id:
                    out += [current.row()] if current else []
                    current = _Digest(conv_id)
                current.add(formatter, text, zip(starts, ends, strict=True))
            if out:
                yield _batch(out, _DIGEST_SCHEMA)
        if current is not None:
            yield _batch([current.row()], _DIGEST_SCHEMA)

    return dealt.select(*columns).mapInArrow(digested, _DIGESTS)


class _Digest:
    """Running digests of a conversation."""

    def __init__(self, conv_id: int | None):
        self.conv_id = conv_id
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.chars = 0

    def add(self, formatter: Formatter, text: str, spans) -> None:
        self.chars += len(text)
        for parsed in formatter.parsed(text):
            self.n_turns += 1
            self.turns.update(f"{parsed.turn.role}\n{parsed.turn.text}\n".encode())
        for start, end in spans:
            masked = formatter.unescaped(text[start:end])
            self.loss_chars += len(masked)
            self.loss.update(masked.encode())

    def row(self) -> tuple:
        turns, loss = self.turns.hexdigest(), self.loss.hexdigest()
        return self.conv_id, self.n_turns, turns, self.loss_chars, loss, self.chars
