"""Formatting conversations with a compiled template, and reading the result back.

Rows of a conversation are brought together in the order of their turns and
rendered as a stream: one output row per turn, numbered, so a conversation of
any length takes the memory of a few turns.  The rows' texts put together are
the formatted conversation; each carries the spans a model is to learn.

Cases: a null text or role counts as empty; rows of equal turn are ordered by
role, then text; a null conversation id is one conversation; a null turn comes
first; repeated rows are turns of their own; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesloom.llm.chat_template import Template, unescape

#: Turns are delimited by <s> ... </s>; users' are marked, assistants' are bare, others carry their role.
TEMPLATE = (
    "{% for m in messages %}<s>"
    "{% if m.role == 'user' %}[INST] {{ m.text|escape }} [/INST]"
    "{% elif m.role == 'assistant' %}{% generation %}{{ m.text|escape }}{% endgeneration %}"
    "{% else %}[ROLE]{{ m.role|escape }}[/ROLE]{{ m.text|escape }}"
    "{% endif %}</s>\n{% endfor %}"
)

_SEGMENT = [("conv_id", pa.int64()), ("part", pa.int64()), ("text", pa.string()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))]
#: Output rows of one batch.
_ROWS = 256


def _in_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for at in range(0, batch.num_rows, _ROWS):
            yield from batch.slice(at, _ROWS).to_pylist()


def _in_batches(rows: Iterator[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held: list[dict] = []
    for row in rows:
        held.append(row)
        if len(held) == _ROWS:
            yield pa.RecordBatch.from_pylist(held, schema)
            held = []
    yield pa.RecordBatch.from_pylist(held, schema)


def format_conversations(conversations: DataFrame, template: str = TEMPLATE, *, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, part, text, spans): the parts of each formatted conversation; a conversation's parts follow one another within a partition."""
    Template(template)  # a faulty template fails here

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = Template(template)

        def parts() -> Iterator[dict]:
            for conv, rows in groupby(_in_rows(batches), key=lambda r: r["conv_id"]):
                for k, segment in enumerate(compiled.stream({"role": r["role"] or "", "text": r["text"] or ""} for r in rows)):
                    yield {"conv_id": conv, "part": k, "text": segment.text, "spans": [{"start": s, "end": e} for s, e in segment.spans]}

        return _in_batches(parts(), pa.schema(_SEGMENT))

    rows = conversations.select(
        F.col(id_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), F.col(role_col).cast("string").alias("role"), F.col(text_col).cast("string").alias("text")
    )
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.select("conv_id", "role", "text").mapInArrow(run, "conv_id long, part long, text string, spans array<struct<start:long,end:long>>")


def read_turns(text: str) -> list[tuple[str, str]]:
    """(role, text) of every turn in formatted text of the default template."""
    turns, at = [], 0
    while (start := text.find("<s>", at)) >= 0:
        start += 3
        stop = text.index("</s>", start)
        if text.startswith("[INST] ", start):
            turns.append(("user", unescape(text[start + 7 : stop - 8])))
        elif text.startswith("[ROLE]", start):
            middle = text.index("[/ROLE]", start)
            turns.append((unescape(text[start + 6 : middle]), unescape(text[middle + 7 : stop])))
        else:
            turns.append(("assistant", unescape(text[start:stop])))
        at = stop + 4
    return turns


_DIGEST = [("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())]


def digests(formatted: DataFrame) -> DataFrame:
    """One row per conversation, read back from its formatted parts: turns, digest of roles and texts, size and digest of the text to learn."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[dict]:
            for conv, parts in groupby(_in_rows(batches), key=lambda r: r["conv_id"]):
                turns, loss = hashlib.sha256(), hashlib.sha256()
                n = loss_chars = chars = 0
                for part in parts:
                    chars += len(part["text"])
                    for role, text in read_turns(part["text"]):
                        n += 1
                        turns.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
                    for span in part["spans"]:
                        learnt = unescape(part["text"][span["start"] : span["end"]])
                        loss_chars += len(learnt)
                        loss.update(learnt.encode("utf-8", "surrogatepass"))
                yield {"conv_id": conv, "n_turns": n, "turns_sha256": turns.hexdigest(), "loss_chars": loss_chars, "loss_sha256": loss.hexdigest(), "formatted_chars": chars}

        return _in_batches(rows(), pa.schema(_DIGEST))

    # No shuffle in between: the parts of a conversation are still together and in order.
    return formatted.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
