"""Chat formatting: conversations through a compiled template.

Turns are dealt by conversation and sorted by turn; each task streams its
conversations through the template's closures.  A conversation is one cell of
the result, so it must fit in a task's memory as any cell must.

Cases: null role or text is empty; turns of equal number are ordered by role,
then text; rows without a conversation id form one conversation with a null
id; repeated rows are turns of their own; other columns are not read; an empty
table gives no rows.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapvault.llm.common import arrow_limits
from snapvault.llm.template import DEFAULT, compile_template, read_turns

FORMATTED = "conv_id long, formatted string, loss_spans array<struct<start: long, end: long>>"
READ = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
OUT_CHARS = 4 << 20


def _format(template: str):
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def batch(rows):
        return pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.string()),
             pa.array([[{"start": s, "end": e} for s, e in r[2]] for r in rows], span)],
            names=["conv_id", "formatted", "loss_spans"])

    def run(batches):
        render = compile_template(template)
        out, chars = [], 0
        conv, messages = None, []
        for b in batches:
            for c, role, text in zip(*(b.column(k).to_pylist() for k in ("conv_id", "role", "text"))):
                if c != conv and messages:
                    out.append((conv, *render({"messages": messages})))
                    chars += len(out[-1][1])
                    messages = []
                    if chars > OUT_CHARS:
                        yield batch(out)
                        out, chars = [], 0
                conv = c
                messages.append({"role": role, "text": text})
        if messages:
            out.append((conv, *render({"messages": messages})))
        if out:
            yield batch(out)

    return run


def format_conversations(conversations: DataFrame, template: str = DEFAULT) -> DataFrame:
    """One row per conversation: conv_id, formatted, loss_spans (code points of the formatted text)."""
    compile_template(template)  # errors show here, not in a task
    arrow_limits(conversations.sparkSession)
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                                F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return (rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
            .mapInArrow(_format(template), FORMATTED))


def _read(batches):
    for b in batches:
        rows = []
        for text, spans in zip(b.column("formatted").to_pylist(), b.column("loss_spans").to_pylist()):
            turns = read_turns(text)
            places = {(s, e): body for _, body, s, e in turns}
            loss = "".join(places[(x["start"], x["end"])] for x in spans)
            whole = hashlib.sha256()
            for role, body, _, _ in turns:
                whole.update(f"{role}\n{body}\n".encode("utf-8", "replace"))
            rows.append((len(turns), whole.hexdigest(), len(loss),
                         hashlib.sha256(loss.encode("utf-8", "replace")).hexdigest(), len(text)))
        cols = list(zip(*rows)) if rows else [[]] * 5
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        yield pa.RecordBatch.from_arrays([b.column("conv_id"), *(pa.array(c, k) for c, k in zip(cols, kinds))],
                                         names=[x.split()[0] for x in READ.split(", ")])


def read_back(formatted: DataFrame) -> DataFrame:
    """One row per formatted conversation: turns and loss text parsed from the output, as counts and digests."""
    return formatted.mapInArrow(_read, READ)
