"""Chat formatting from an event log.

A conversation is a log of events (conv_id, seq, slot, kind, role, text):

* ``start`` opens message ``slot`` with a role (and text, if any);
* ``delta`` appends streamed text to the slot;
* ``edit`` replaces the slot's text (and its role, if given);
* ``regenerate`` drops the slot's text; later deltas write it anew.

Folding works per message, not per conversation: rows are grouped by
(conversation, slot), so one very long conversation spreads over many tasks.
The last start, edit or regenerate decides where a message's text begins; the
deltas after it are appended in order of ``seq`` (ties by text).  Messages of
a conversation are in order of slot.

Rendering: ``<s>role LF text</s> LF``.  Inside roles and texts a backslash is
doubled and the first character of a control string (``<s>``, ``</s>``,
``[INST]``, ``[/INST]``) becomes ``\\x3c`` or ``\\x5b``; a line feed in a role
becomes ``\\n``.  No control string can so appear in a text, and unescaping
gives the exact text back.  The loss mask of a segment is the code point range
of its (escaped) text if its role is assistant.  The output is one row per
message segment, written to the shared folder; a conversation's formatted
string is its segments in order.

Reading back: segments are partitioned by conversation and sorted by position
inside a task's sort (which spills), and digests are updated segment by
segment, so memory is bounded by one message.

Null text or role is empty, null conv_id is a conversation of its own, a null
turn sorts first, repeated rows are turns of their own.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import in_tasks

#: Control strings of the template and of common chat templates, never left inside a text.
_CONTROL = re.compile(r"\\|<(?=/?s>)|\[(?=/?INST\])")
_SAFE = {"\\": "\\\\", "<": "\\x3c", "[": "\\x5b"}
_ESCAPED = re.compile(r"\\(\\|x3c|x5b|n)")
_BACK = {"\\": "\\", "x3c": "<", "x5b": "[", "n": "\n"}
LOSS_ROLE = "assistant"


def escape(text: str, line: bool = False) -> str:
    out = _CONTROL.sub(lambda m: _SAFE[m[0]], text)
    return out.replace("\n", "\\n") if line else out


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: _BACK[m[1]], text)


def fold(events: DataFrame) -> DataFrame:
    """(conv_id, slot, role, text) of the final messages.  Null conversations
    and slots group like any other value."""
    e = events.select("conv_id", "slot", "seq", "kind", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
                      F.col("role").isNotNull().alias("named"))
    item = F.struct(F.col("seq"), F.col("kind"), F.col("text"), F.col("role"), F.col("named"))
    log = F.array_sort(F.collect_list(item))      # the events of one message
    # a reset at position p (from 1) keeps what follows; 0: no reset
    reset = F.array_max(F.transform("log", lambda x, i: F.when(x["kind"] != "delta", i + 1).otherwise(0)))
    named = F.filter("log", lambda x: x["named"] & x["kind"].isin("start", "edit"))
    first = F.try_element_at("log", F.greatest(F.col("at"), F.lit(1)))
    head = F.when((F.col("at") > 0) & (first["kind"] != "regenerate"), first["text"]).otherwise(F.lit(""))
    tail = F.array_join(F.transform(F.slice("log", F.col("at") + 1, F.greatest(F.size("log") - F.col("at"), F.lit(0))), lambda x: x["text"]), "")
    return (e.groupBy("conv_id", "slot").agg(log.alias("log")).withColumn("at", reset)
            .select("conv_id", "slot", F.coalesce(F.try_element_at(named, F.lit(-1))["role"], F.lit("")).alias("role"),
                    F.concat(head, tail).alias("text")))


def render(messages: DataFrame) -> DataFrame:
    """Segments: conv_id, slot, segment, loss_start, loss_end (code points in the segment; equal: no loss)."""

    def rows(batches) -> Iterator[pa.RecordBatch]:
        for b in batches:
            segments, starts, ends = [], [], []
            for role, text in zip(b.column(2).to_pylist(), b.column(3).to_pylist()):
                head, body = f"<s>{escape(role, line=True)}\n", escape(text)
                segments.append(f"{head}{body}</s>\n")
                starts.append(len(head))
                ends.append(len(head) + (len(body) if role == LOSS_ROLE else 0))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(segments, pa.string()), pa.array(starts, pa.int64()),
                                              pa.array(ends, pa.int64())], ["conv_id", "slot", "segment", "loss_start", "loss_end"])

    kinds = {f.name: f.dataType.simpleString() for f in messages.schema}
    return messages.select("conv_id", "slot", "role", "text").transform(in_tasks(
        rows, f"conv_id {kinds['conv_id']}, slot {kinds['slot']}, segment string, loss_start long, loss_end long"))


class _Digest:
    def __init__(self):
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n = self.loss_chars = self.chars = 0

    def add(self, segment: str, a: int, b: int) -> None:
        role, body = segment.removeprefix("<s>").removesuffix("</s>\n").split("\n", 1)
        self.turns.update(f"{unescape(role)}\n{unescape(body)}\n".encode())
        if b > a:
            text = unescape(segment[a:b])
            self.loss.update(text.encode())
            self.loss_chars += len(text)
        self.n += 1
        self.chars += len(segment)

    def row(self, conv_id):
        return (conv_id, self.n, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars)


def read_back(segments: DataFrame) -> DataFrame:
    """Per conversation: n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars."""
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kind = segments.schema["conv_id"].dataType.simpleString()

    def rows(batches) -> Iterator[pa.RecordBatch]:
        open_id, digest, done, schema = None, None, [], None
        for b in batches:
            if schema is None:
                schema = pa.schema([("conv_id", b.schema.field(0).type), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                                    ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])
            for key, segment, a, z in zip(*(b.column(i).to_pylist() for i in range(4))):
                if digest is None or key != open_id:
                    if digest is not None:
                        done.append(digest.row(open_id))
                    open_id, digest = key, _Digest()
                digest.add(segment, a, z)
            if len(done) > 1000:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*done), schema.types)], schema=schema)
                done = []
        if digest is not None:
            done.append(digest.row(open_id))
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*done), schema.types)], schema=schema)

    ordered = segments.repartition("conv_id").sortWithinPartitions("conv_id", "slot").select("conv_id", "segment", "loss_start", "loss_end")
    return ordered.transform(in_tasks(rows, f"{names[0]} {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"))


def events_of_turns(turns: DataFrame) -> DataFrame:
    """The event log of a table of finished turns: a start with the role and
    one delta with the text for every row.  A slot is the turn and the row's
    place among rows that repeat it."""
    same = Window.partitionBy("conv_id", "turn").orderBy("role", "text")
    rows = turns.select("conv_id", "turn", "role", "text").withColumn("copy", F.row_number().over(same))
    slot = F.struct("turn", "copy").alias("slot")
    both = F.array(F.struct(F.lit(0).alias("seq"), F.lit("start").alias("kind"), F.coalesce("role", F.lit("")).alias("role"), F.lit("").alias("text")),
                   F.struct(F.lit(1).alias("seq"), F.lit("delta").alias("kind"), F.lit(None).cast("string").alias("role"), F.col("text").alias("text")))
    return rows.select("conv_id", slot, F.explode(both).alias("e")).select("conv_id", "slot", "e.*")


def format_conversations(events: DataFrame) -> DataFrame:
    """Fold, render, write, and read the written segments back."""
    return read_back(materialize(render(fold(events)), "chat_segments"))
