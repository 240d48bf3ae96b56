"""Chat formatting from event logs.

A log holds events of conversations: ``delta`` appends to a message's text,
``edit`` replaces it, ``regenerate`` starts it anew, ``delete`` removes the
message. Logs are partitioned by conversation and sorted by message and
sequence number; one pass folds the events of a message into its final text and
renders it at once. A task holds one message, however long the conversation;
its messages pass through one task in order, as the rendered text is a sequence.

Turns are written ``<|im_start|>role\\ntext<|im_end|>\\n``. Inside texts and roles
every control string of ``CONTROLS`` gets a backslash after its first character,
one more if it has some there already, so no control string is left and
unescaping is exact. In roles a backslash and a newline are escaped as well.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
# Strings that common chat templates treat as control tokens.
CONTROLS = (START, END, "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")

_HEADS = "".join(re.escape(c) for c in sorted({c[0] for c in CONTROLS}))
_RESTS = "|".join(re.escape(c[1:]) for c in sorted(CONTROLS, key=len, reverse=True))
_BARE = re.compile(rf"([{_HEADS}])(\\*)(?={_RESTS})")
_ESCAPED = re.compile(rf"([{_HEADS}])\\(\\*)(?={_RESTS})")
_TURN = re.compile(rf"{re.escape(START)}(.*)\n([\s\S]*?){re.escape(END)}\n")


def escape(text: str) -> str:
    return _BARE.sub(r"\1\\\2", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


@dataclass
class Message:
    """The fold of one message's events."""

    role: str = ""
    alive: bool = False
    pieces: list[str] = field(default_factory=list)

    def apply(self, kind: str | None, role: str | None, text: str | None) -> None:
        if role is not None:
            self.role = role
        if kind == "delete":
            self.alive, self.pieces = False, []
            return
        self.alive = True
        if kind in ("edit", "regenerate"):
            self.pieces = []
        elif kind != "delta":
            raise ValueError(f"unknown event {kind!r}")
        self.pieces.append(text or "")

    def rendered(self) -> str:
        return f"{START}{escape_role(self.role)}\n{escape(''.join(self.pieces))}{END}\n"


def render(events: DataFrame, conversation: str, message: str, sequence: str, kind: str, role: str, text: str, trained: str = "assistant") -> DataFrame:
    """(``conversation``, ``position``, ``formatted``, ``loss_begin``, ``loss_end``), one row per message left.

    Messages are ordered by ``message``, events by ``sequence`` and then by their
    content; nulls come first. A null text is empty, the last role given holds, a
    null role is empty. Rows of a null conversation form one conversation.
    ``formatted`` parts of a conversation in order of ``position`` are its text;
    ``loss_begin`` to ``loss_end`` (code points in the part) is the text of a
    message whose role is ``trained``, null for others. The result is partitioned
    by conversation and in order within partitions.
    """
    log = events.select(
        F.col(conversation).cast("long").alias("conversation"),
        F.col(message).cast("long").alias("message"),
        F.col(sequence).cast("long").alias("sequence"),
        F.col(kind).cast("string").alias("kind"),
        F.col(role).cast("string").alias("role"),
        F.col(text).cast("string").alias("text"),
    )
    laid = log.repartition("conversation").sortWithinPartitions("conversation", "message", "sequence", "kind", "role", "text")
    schema = pa.schema(
        [("conversation", pa.int64()), ("position", pa.int64()), ("formatted", pa.string()), ("loss_begin", pa.int64()), ("loss_end", pa.int64())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current: tuple | None = None
        folded, position, out, held = Message(), 0, [], 0

        def close() -> None:
            nonlocal position, held
            if current is None or not folded.alive:
                return
            formatted = folded.rendered()
            begin = len(START) + len(escape_role(folded.role)) + 1
            marks = (begin, len(formatted) - len(END) - 1) if folded.role == trained else (None, None)
            out.append((current[0], position, formatted, *marks))
            position += 1
            held += len(formatted)

        for batch in batches:
            for row in batch.to_pylist():
                key = (row["conversation"], row["message"])
                if key != current:
                    close()
                    if current is None or key[0] != current[0]:
                        position = 0
                    current, folded = key, Message()
                folded.apply(row["kind"], row["role"], row["text"])
                if held > 1 << 20:
                    yield _rows(out, schema)
                    out, held = [], 0
        close()
        if out:
            yield _rows(out, schema)

    return laid.mapInArrow(run, "conversation long, position long, formatted string, loss_begin long, loss_end long")


def _rows(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def turns(formatted: str) -> Iterator[tuple[str, str]]:
    """(role, text) of all turns of a formatted text."""
    at = 0
    for found in _TURN.finditer(formatted):
        if found.start() != at:
            break
        at = found.end()
        yield unescape_role(found[1]), unescape(found[2])
    if at != len(formatted):
        raise ValueError("not a formatted conversation")


def summaries(rendered: DataFrame) -> DataFrame:
    """Per conversation, read back from the formatted text: ``n_turns``,
    ``turns_sha256``, ``loss_chars``, ``loss_sha256`` and ``formatted_chars``.

    ``rendered`` must be partitioned by conversation and in order, as ``render``
    leaves it; parts are digested one by one.
    """
    schema = pa.schema(
        [("conversation", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
         ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, open_, out = None, False, []

        def close() -> None:
            if open_:
                out.append((current, n, whole.hexdigest(), loss_chars, loss.hexdigest(), chars))

        n = loss_chars = chars = 0
        whole, loss = hashlib.sha256(), hashlib.sha256()
        for batch in batches:
            for key, _, text, begin, end in zip(*(c.to_pylist() for c in batch.columns)):
                if not open_ or key != current:
                    close()
                    current, open_ = key, True
                    n = loss_chars = chars = 0
                    whole, loss = hashlib.sha256(), hashlib.sha256()
                chars += len(text)
                for role, body in turns(text):
                    n += 1
                    whole.update(f"{role}\n{body}\n".encode("utf-8", "surrogatepass"))
                if begin is not None:
                    body = unescape(text[begin:end])
                    loss_chars += len(body)
                    loss.update(body.encode("utf-8", "surrogatepass"))
            if len(out) > 10_000:
                yield _rows(out, schema)
                out = []
        close()
        if out:
            yield _rows(out, schema)

    return rendered.mapInArrow(
        run, "conversation long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    )
