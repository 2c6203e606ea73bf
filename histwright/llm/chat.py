"""Chat formatting whose output parses back to exactly the turns that went in.

Every turn is rendered between control strings of its own::

    system     <<SYS>> text <</SYS>>
    user       [INST] text [/INST]
    assistant  <s> text </s>
    others     [ROLE] name [TEXT] text [/ROLE]

The grammar is deterministic: at a turn boundary an opener must follow, the text
goes on to the next control string, and that must be the turn's own closer. A
control string with one backslash or more after its bracket is text that has been
escaped, and reading takes one backslash away. A turn is first rendered as it
is and parsed; when what comes back is not the one turn that went in, every control
string in it (escaped or not) gets one backslash, until it is identical. As no control
string can straddle a turn's end, turns that parse one by one parse together.

Rendering and checking happen turn by turn where the rows are read, before anything is shuffled,
so a conversation of any length costs no task more than passing its text on. One
shuffle by conversation then sorts the rendered turns on disk and joins them to parts
of at most ``part_chars`` characters (or one turn); no conversation is held as a whole.

Defined results: turns go by ``turn`` (NULL first), then role and rendered text, so repeated
rows and ties are kept, in a fixed order; a NULL text is empty, a NULL role is the empty name, NULL
``conv_id`` rows form one conversation; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SYSTEM, USER, ASSISTANT = "system", "user", "assistant"
#: Opener and closer of the named roles (fixed values of the template).
MARKS = {SYSTEM: ("<<SYS>> ", " <</SYS>>"), USER: ("[INST] ", " [/INST]"), ASSISTANT: ("<s> ", " </s>")}
ROLE, TEXT, ROLE_END = "[ROLE] ", " [TEXT] ", " [/ROLE]"
#: Any control string; the group holds its backslashes.
CONTROL = re.compile(r"<<(\\*)/?SYS>>|<(\\*)/?s>|\[(\\*)(?:/?INST|/?ROLE|TEXT)\]")
PART_CHARS = 1 << 20
PARTS = "conv_id long, part long, text string, loss array<struct<start:long,length:long>>"


class Conflict(ValueError):
    """Rendered text that the grammar does not accept."""


def _slashes(m: re.Match) -> int:
    """Where the backslashes of a control string end."""
    return m.end(m.lastindex)


def escape(text: str) -> str:
    return CONTROL.sub(lambda m: m[0][:_slashes(m) - m.start()] + "\\" + m[0][_slashes(m) - m.start():], text)


def unescape(text: str) -> str:
    def less(m: re.Match) -> str:
        at = _slashes(m) - m.start()
        return m[0][:at - 1] + m[0][at:] if m[m.lastindex] else m[0]
    return CONTROL.sub(less, text)


def next_control(text: str, at: int) -> tuple[int, int]:
    """(start, end) of the next control string without a backslash."""
    for m in CONTROL.finditer(text, at):
        if not m[m.lastindex]:
            return m.start(), m.end()
    raise Conflict("text without its closing control string")


def _until(text: str, at: int, closer: str) -> tuple[str, int]:
    """The text from ``at`` to the next control string, which must be ``closer``; and where that ends."""
    start, end = next_control(text, at)
    if start - 1 < at or end != start - 1 + len(closer.rstrip(" ")) or not text.startswith(closer, start - 1):
        raise Conflict(f"expected {closer!r} at {start}")
    return text[at:start - 1], start - 1 + len(closer)


def parse(text: str, at: int = 0) -> Iterator[tuple[str, str, int, int]]:
    """(role, text, where the escaped text starts, where it ends) of every turn."""
    while at < len(text):
        role = next((r for r, (opener, _) in MARKS.items() if text.startswith(opener, at)), None)
        if role is not None:
            opener, closer = MARKS[role]
            start = at + len(opener)
            body, at = _until(text, start, closer)
        elif text.startswith(ROLE, at):
            name, start = _until(text, at + len(ROLE), TEXT)
            role = unescape(name)
            body, at = _until(text, start, ROLE_END)
        else:
            raise Conflict(f"no turn starts at {at}")
        yield role, unescape(body), start, start + len(body)


def render(role: str, text: str) -> str:
    if role in MARKS:
        opener, closer = MARKS[role]
        return opener + text + closer
    return ROLE + role + TEXT + text + ROLE_END


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """(rendered turn, start and end of its escaped text), escaped until it parses back to itself."""
    name, body = role, text
    while True:
        rendered = render(name, body)
        try:
            found = list(parse(rendered))
        except Conflict:
            found = []
        if len(found) == 1 and found[0][:2] == (role, text):
            return rendered, found[0][2], found[0][3]
        if (name, body) != (role, text):
            raise Conflict(f"a turn of {role!r} does not come back from its escaped form")
        name, body = role if role in MARKS else escape(role), escape(text)


def rendered_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, out (rendered turn), start, stop (of its text): one row per turn."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            role, text = (batch.column(i).to_pylist() for i in (2, 3))
            done = [format_turn(r, t) for r, t in zip(role, text)]
            out, start, stop = zip(*done) if done else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(role, pa.string()), pa.array(out, pa.string()),
                 pa.array(start, pa.int64()), pa.array(stop, pa.int64())],
                ["conv_id", "turn", "role", "out", "start", "stop"])

    return (conversations.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"),
                                 F.coalesce("text", F.lit("")).alias("text"))
            .mapInArrow(run, "conv_id long, turn long, role string, out string, start long, stop long"))


def format_chats(conversations: DataFrame, part_chars: int = PART_CHARS) -> DataFrame:
    """conv_id, part, text, loss: the formatted conversations in parts, each cut between two turns.

    ``loss`` lists where the assistants' texts stand in the part's text. All parts of a conversation are in one
    partition, in order, none between them; so :func:`read_back` may follow without another shuffle.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, part, texts, size, loss, rows = None, 0, [], 0, [], []

        def cut() -> None:
            nonlocal part, texts, size, loss
            rows.append((now[0], part, "".join(texts), loss))
            part, texts, size, loss = part + 1, [], 0, []

        def flush() -> pa.RecordBatch:
            cols = list(zip(*rows))
            rows.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.string()),
                 pa.array(cols[3], pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())])))],
                ["conv_id", "part", "text", "loss"])

        waiting = 0
        for batch in batches:
            for conv, role, out, start, stop in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3, 4, 5))):
                if now != (conv,) or size + len(out) > part_chars:
                    if texts:
                        waiting += size
                        cut()
                    if now != (conv,):
                        now, part = (conv,), 0
                    if waiting >= part_chars:
                        yield flush()
                        waiting = 0
                if role == ASSISTANT:
                    loss.append({"start": size + start, "length": stop - start})
                texts.append(out)
                size += len(out)
        if texts:
            cut()
        if rows:
            yield flush()

    turns = rendered_turns(conversations)
    # Of turns with equal numbers, the rendered text decides after the role.
    return (turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "out")
            .mapInArrow(run, PARTS))


def read_back(parts: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars of :func:`format_chats`' rows,
    read from the formatted text and the loss spans alone."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        now = None
        rows: list[tuple] = []

        def done() -> None:
            rows.append((now[0], n, turns.hexdigest(), chars, masked.hexdigest(), size))

        def flush() -> pa.RecordBatch:
            cols = list(zip(*rows))
            rows.clear()
            types = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, types)],
                ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

        for batch in batches:
            for conv, text, loss in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3))):
                if now != (conv,):
                    if now is not None:
                        done()
                        if len(rows) >= 5000:
                            yield flush()
                    now, n, chars, size = (conv,), 0, 0, 0
                    turns, masked = hashlib.sha256(), hashlib.sha256()
                for role, said, _, _ in parse(text):
                    turns.update(f"{role}\n{said}\n".encode())
                    n += 1
                for span in loss:
                    said = unescape(text[span["start"]:span["start"] + span["length"]])
                    masked.update(said.encode())
                    chars += len(said)
                size += len(text)
        if now is not None:
            done()
        if rows:
            yield flush()

    return parts.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
                                 "loss_sha256 string, formatted_chars long")
