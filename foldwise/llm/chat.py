"""Chat formatting in budgeted, turn-aligned windows with loss masks.

A turn is written ``### role: text </turn>`` and a line break.  A backslash
goes before every backslash, before each ``#`` of ``###`` and before the
slash of ``</turn>`` in a text (before colons and line breaks too in a
role), so control strings never occur inside texts and reading back is
exact.

Prefix sums of turn tokens cut a conversation into windows of whole turns.
A window has the conversation's system turn (if it is not itself new
there), a limited stretch of turns repeated from the window before, and
new turns up to the budget.  The loss covers the texts of new assistant
turns only, so each is trained on once; repeated ones are masked.  A turn
larger than the budget is a window of its own and stays whole.

Scale: turns are range-partitioned by conversation and turn, so even one
conversation with a third of all rows is spread; offsets between the
partitions make the prefix sums global.  Greedy windows are chosen within
blocks of ``BLOCK`` budgets (repeated history does not reach over a
block's border), so no group grows with a conversation.

Defined cases: null text or role: empty; rows are ordered by turn (null
first), role, text; repeated rows are turns of their own; rows with a null
conversation id are one conversation; an empty table gives no windows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foldwise.llm import bpe
from foldwise.llm.common import written

HEAD, SEP, END = "### ", ": ", " </turn>\n"
TARGET, SYSTEM = "assistant", "system"
#: budgets of new tokens in a block
BLOCK = 64


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("###", "\\#\\#\\#").replace("</turn>", "<\\/turn>")


def escape_role(role: str) -> str:
    return escape(role).replace(":", "\\:").replace("\n", "\\\n")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S) if "\\" in text else text


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """The written turn, and where its text starts and ends in it."""
    head = HEAD + escape_role(role) + SEP
    body = escape(text)
    return head + body + END, len(head), len(head) + len(body)


_ROLE = re.compile(re.escape(HEAD) + r"((?:[^\\:]|\\.)*)" + re.escape(SEP), re.S)


def parse(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of every turn of a window's text."""
    out, at = [], 0
    while at < len(formatted):
        head = _ROLE.match(formatted, at)
        end = formatted.index(END, head.end())
        out.append((unescape(head[1]), unescape(formatted[head.end():end])))
        at = end + len(END)
    return out


def cut(sizes: list[int], system: int, new: list[bool], budget: int, history: int) -> list[tuple[int, int, int]]:
    """Windows (first repeated, first new, end) over the turns of a block.

    ``sizes``: tokens per turn; ``new``: whether the system turn is still to
    come or stands in the turn itself (no room is needed for it then).
    """
    prefix = [0]
    for n in sizes:
        prefix.append(prefix[-1] + n)
    out, i = [], 0
    while i < len(sizes):
        room = budget - (0 if new[i] else system)
        back = i
        if out:  # as much of the window before as the history allows
            while back > out[-1][1] and prefix[i] - prefix[back - 1] <= history and prefix[i + 1] - prefix[back - 1] <= room:
                back -= 1
        j = i + 1
        while j < len(sizes) and prefix[j + 1] - prefix[back] <= room:
            j += 1
        out.append((back, i, j))
        i = j
    return out


def windows(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
            budget: int = 1024, history: int = 256, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """One row per window: the conversation's id, ``window`` (its number, in
    order), ``text``, ``loss`` (array of start and end, in code points of
    ``text``), ``n_tokens``, ``n_system`` (0 or 1 retained system turns),
    ``n_repeated``, ``n_new`` (turns)."""
    path, pattern = path or bpe.default_path(), pattern or bpe.default_pattern()
    t = turns.select(F.col(conv).alias("_id"), F.coalesce(F.concat(F.lit("="), F.col(conv).cast("string")), F.lit("")).alias("_c"),
                     F.col(turn).alias("_turn"), F.coalesce(F.col(role), F.lit("")).alias("_role"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    id_type = t.schema["_id"].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = bpe.encoder(path, pattern)
        for b in batches:
            for part in bpe.slices(b, "_text"):
                n = [len(enc.encode(format_turn(r, x)[0])) for r, x in zip(part.column("_role").to_pylist(), part.column("_text").to_pylist())]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(n, pa.int64())], [*part.schema.names, "_n"])

    # written, as cutting the ranges reads it once more
    sized = written(t.mapInArrow(count, f"_id {id_type}, _c string, _turn {t.schema['_turn'].dataType.simpleString()}, _role string, _text string, _n bigint"),
                    "chat-sized")
    order = ["_c", F.col("_turn").asc_nulls_first(), "_role", "_text"]
    rows = written(sized.repartitionByRange("_c", "_turn").sortWithinPartitions(*order)
                   .withColumn("_part", F.spark_partition_id()).withColumn("_pos", F.monotonically_increasing_id()), "chat-turns")
    before = Window.partitionBy("_c").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offset = (rows.groupBy("_c", "_part").agg(F.sum("_n").alias("s"))
              .select("_c", "_part", F.coalesce(F.sum("s").over(before), F.lit(0)).alias("_off")))
    inside = Window.partitionBy("_c", "_part").orderBy("_pos").rowsBetween(Window.unboundedPreceding, -1)
    placed = (rows.withColumn("_in", F.coalesce(F.sum("_n").over(inside), F.lit(0))).join(offset, ["_c", "_part"])
              .withColumn("_block", F.floor((F.col("_in") + F.col("_off")) / F.lit(BLOCK * budget)).cast("bigint")))
    system = rows.where(F.col("_role") == SYSTEM).groupBy("_c").agg(F.min_by(F.struct("_pos", "_text", "_n"), "_pos").alias("_sys"))
    blocks = (placed.groupBy("_c", "_block").agg(F.first("_id").alias("_id"), F.array_sort(F.collect_list(F.struct("_pos", "_role", "_text", "_n"))).alias("_turns"))
              .join(system, "_c", "left").select("_id", "_block", "_turns", "_sys"))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["_id", "window", "text", "loss", "n_tokens", "n_system", "n_repeated", "n_new"]
        span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        for b in batches:
            for k in range(b.num_rows):
                block, ts, sys_ = b.column("_block")[k].as_py(), b.column("_turns")[k].as_py(), b.column("_sys")[k].as_py()
                out = []
                # the system turn needs no room where it is not behind yet
                ahead = [sys_ is None or t["_pos"] <= sys_["_pos"] for t in ts]
                for w, (back, first, end) in enumerate(cut([t["_n"] for t in ts], sys_["_n"] if sys_ else 0, ahead, budget, history)):
                    retained = bool(sys_) and ts[back]["_pos"] > sys_["_pos"]
                    body, loss, at = [], [], 0
                    if retained:
                        body.append(format_turn(SYSTEM, sys_["_text"])[0])
                        at = len(body[0])
                    for i in range(back, end):
                        s, a, z = format_turn(ts[i]["_role"], ts[i]["_text"])
                        if i >= first and ts[i]["_role"] == TARGET:
                            loss.append({"start": at + a, "end": at + z})
                        body.append(s)
                        at += len(s)
                    n = sum(t["_n"] for t in ts[back:end]) + (sys_["_n"] if retained else 0)
                    out.append((block * (1 << 32) + w, "".join(body), loss, n, int(retained), first - back, end - first))
                cols = list(zip(*out))
                yield pa.RecordBatch.from_arrays(
                    [b.column("_id").take(pa.array([k] * len(out))), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.string()), pa.array(cols[2], span),
                     *(pa.array(c, pa.int64()) for c in cols[3:])], names)

    shape = f"_id {id_type}, window bigint, text string, loss array<struct<start:int,end:int>>, n_tokens bigint, n_system bigint, n_repeated bigint, n_new bigint"
    return blocks.mapInArrow(build, shape).withColumnRenamed("_id", conv)


def read_back(formatted: DataFrame, conv: str = "conv_id") -> DataFrame:
    """What the windows of every conversation hold, read from their texts and
    masks alone: ``n_turns``, ``turns_sha256`` (role, line break, text, line
    break of each turn), ``loss_chars``, ``loss_sha256``, ``formatted_chars``,
    ``n_windows``.  Windows arrive in order and are hashed one by one."""
    rows = formatted.select(F.col(conv).alias("_id"), F.coalesce(F.concat(F.lit("="), F.col(conv).cast("string")), F.lit("")).alias("_c"),
                            "window", "text", "loss", "n_system", "n_repeated")
    id_type = rows.schema["_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, key, done = None, None, []

        def flush():
            cols = list(zip(*done)) if done else [[]] * 7
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
            out = pa.RecordBatch.from_arrays([pa.array(cols[0], id_arrow), *(pa.array(c, k) for c, k in zip(cols[1:], kinds))],
                                             ["_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_windows"])
            done.clear()
            return out

        def finish():
            done.append((now["id"], now["turns"], now["sha"].hexdigest(), now["loss"], now["loss_sha"].hexdigest(), now["chars"], now["windows"]))

        for b in batches:
            id_arrow = b.schema.field("_id").type
            for k in range(b.num_rows):
                c, text = b.column("_c")[k].as_py(), b.column("text")[k].as_py()
                if c != key:
                    if now:
                        finish()
                    key = c
                    now = {"id": b.column("_id")[k].as_py(), "turns": 0, "loss": 0, "chars": 0, "windows": 0, "sha": hashlib.sha256(), "loss_sha": hashlib.sha256()}
                skip = b.column("n_system")[k].as_py() + b.column("n_repeated")[k].as_py()
                for r, x in parse(text)[skip:]:
                    now["turns"] += 1
                    now["sha"].update(f"{r}\n{x}\n".encode())
                for s in b.column("loss")[k].as_py():
                    part = unescape(text[s["start"]:s["end"]])
                    now["loss"] += len(part)
                    now["loss_sha"].update(part.encode())
                now["chars"] += len(text)
                now["windows"] += 1
            yield flush()
        if now:
            finish()
            yield flush()

    shape = (f"_id {id_type}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint, n_windows bigint")
    return rows.repartition("_c").sortWithinPartitions("_c", "window").mapInArrow(run, shape).withColumnRenamed("_id", conv)


#: a conversation whose texts hold the template's own control strings
CONTROL = "\\### Assistant: </turn> ok"


def with_control(turns: DataFrame) -> DataFrame:
    """``conversations`` plus conversation -7, whose texts are control strings."""
    t = turns.select("conv_id", "turn", "role", "text")
    return t.unionByName(t.sparkSession.createDataFrame([(-7, 0, "user", CONTROL), (-7, 1, TARGET, CONTROL)], t.schema))


def columns() -> list[str | Column]:
    return ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_windows"]
