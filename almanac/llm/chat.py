r"""Chat formatting by grammar round trip.

A turn is rendered ``<|im_start|>role\ntext<|im_end|>\n``. The parser is deterministic: it takes control strings as they
stand and strips one backslash from every escaped one. A turn is first rendered as it is and parsed; if that does not
give back its role and text, the conflicting content gets one more backslash after its first character and is parsed
again, until source and parse are identical.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
#: Strings that no text may hold unescaped: this template's marks and those of other common ones.
CONTROLS = (START, END, "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
LOSS_ROLE = "assistant"
_any = "|".join(f"{re.escape(c[0])}(?:\\\\*){re.escape(c[1:])}" for c in CONTROLS)
_control = re.compile(_any)


def escape(text: str) -> str:
    return _control.sub(lambda m: m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str) -> str:
    """Raises ValueError at a control string that isn't escaped."""

    def less(m):
        if m[0][1] != "\\":
            raise ValueError(f"unescaped {m[0]}")
        return m[0][0] + m[0][2:]

    return _control.sub(less, text)


def _role_out(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def _role_in(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def parse_turn(rendered: str) -> tuple[str, str]:
    """Role and text of one rendered turn."""
    if not (rendered.startswith(START) and rendered.endswith(f"{END}\n")):
        raise ValueError("not a turn")
    head, mark, text = rendered[len(START) : -len(END) - 1].partition("\n")
    if not mark:
        raise ValueError("no end of role")
    return _role_in(head), unescape(text)


def render_turn(role: str, text: str) -> str:
    """The least escaped form that parses to the same role and text."""
    head, body = _role_out(role), text
    while True:
        rendered = f"{START}{head}\n{body}{END}\n"
        try:
            if parse_turn(rendered) == (role, text):
                return rendered
        except ValueError:
            pass
        if body != text:
            raise AssertionError("an escaped turn must parse")
        body = escape(text)


def format_conversations(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, turn, role, text, formatted, loss) per turn, rendered and read back: role and text are the parser's.

    Null texts and roles count as empty. loss marks the turns of the assistant. A conversation's formatted text is that of
    its turns in the order of turn (nulls first; ties by role, then text). Repeated rows are turns of their own. A very long
    text is rendered and parsed whole, in time that follows its length.
    """

    def run(batches):
        for batch in batches:
            conv, turn, roles, texts = (c.to_pylist() for c in batch.columns)
            formatted = [render_turn(r or "", t or "") for r, t in zip(roles, texts, strict=True)]
            back = [parse_turn(x) for x in formatted]
            yield pa.RecordBatch.from_arrays(
                [pa.array(conv, pa.int64()), pa.array(turn, pa.int64()), *(pa.array([b[k] for b in back], pa.string()) for k in (0, 1)), pa.array(formatted, pa.string()), pa.array([b[0] == LOSS_ROLE for b in back], pa.bool_())],
                ["conv_id", "turn", "role", "text", "formatted", "loss"],
            )

    rows = turns.select(F.col(id_col).cast("bigint").alias("conv_id"), F.col(turn_col).cast("bigint").alias("turn"), F.col(role_col).cast("string").alias("role"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "conv_id bigint, turn bigint, role string, text string, formatted string, loss boolean")


def parse_stream(pieces):
    """Turns of a formatted conversation that arrives in pieces; holds one turn at most."""
    held = ""
    for piece in pieces:
        held += piece
        while (cut := held.find(f"{END}\n")) >= 0:
            cut += len(END) + 1
            yield parse_turn(held[:cut])
            held = held[cut:]
    if held:
        raise ValueError("unfinished turn")


def digest_conversations(formatted: DataFrame) -> DataFrame:
    """One row per conversation, read back from its formatted text: turns, digests, characters under the loss mask.

    The rows of a conversation meet in turn order and stream through running digests; none is held whole, but one task
    reads all of one. Rows without a conversation's id make up one of their own; turns of one number stand by role, then
    text, those without one first. No rows give none.
    """
    kinds = {"conv_id": pa.int64(), "n_turns": pa.int64(), "turns_sha256": pa.string(), "loss_chars": pa.int64(), "loss_sha256": pa.string(), "formatted_chars": pa.int64()}

    def run(batches):
        key, state, out = None, None, []

        def done():
            n, turns, chars, loss, size = state
            out.append((key[0], n, turns.hexdigest(), chars, loss.hexdigest(), size))

        for batch in batches:
            for conv, rendered in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if key is None or key[0] != conv:
                    if key is not None:
                        done()
                    key, state = (conv,), [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, text in parse_stream([rendered]):
                    state[0] += 1
                    state[1].update(f"{role}\n{text}\n".encode())
                    if role == LOSS_ROLE:
                        state[2] += len(text)
                        state[3].update(text.encode())
                state[4] += len(rendered)
            if len(out) >= 4096:
                yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], t) for k, t in enumerate(kinds.values())], list(kinds))
                out = []
        if key is not None:
            done()
        yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], t) for k, t in enumerate(kinds.values())], list(kinds))

    ordered = formatted.select("conv_id", "formatted", "turn", "role", "text").repartition("conv_id")
    ordered = ordered.sortWithinPartitions(F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), "role", "text").select("conv_id", "formatted")
    return ordered.mapInArrow(run, "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint")
