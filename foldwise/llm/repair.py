"""Conversation structure repair: cheapest edits by a bidirectional Dijkstra.

A well-formed conversation has the role initials ``(s?(ua)+)?``.  The edit
lattice has a node per (rows read, state), the state being what was written
last: nothing, the system turn, a user turn, an assistant turn.  Its edges:

====== ==== =======================================================
Keep   0    the row as it is
Rerole 3    the row as user or assistant, whichever may stand here
Delete 4    required for blank and duplicate rows
Insert 3    an empty user or assistant turn, whichever may stand here
====== ==== =======================================================

A truncated row that is not deleted adds 3.  At every node each letter has at
most one edge, so an audit (the letters in order) says which edits it
stands for.  A forward heap from the first node and a reverse heap from the
last ones meet; both go on while a path as cheap as the best one may still be
open, then the least concatenated audit of all crossings is taken.

Rows are dealt by ranges of (conversation, turn), so a conversation of any
length is spread over tasks.  A task solves ``BLOCK`` rows at a time, and
blocks are chained: for each state before and after, the cheapest audit.
Pieces of a conversation in several ranges are chained once more.

Defined cases: rows go by turn, nulls first, those of one turn by role and
text.  A null role or text is one space.  A row equal to another of its
conversation in turn, role and text is a duplicate after the first.  A role
that begins with none of s, u, a is never kept.  A conversation without rows
has no gaps, no audit and no repaired turns.  A null conversation id is an
id of its own.  Columns other than the four are not read.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldwise.llm.common import sha256_hex, written

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COST = {KEEP: 0, REROLE: 3, DELETE: 4, INSERT: 3}
#: what an undeleted truncated row adds
TRUNCATED_COST = 3
#: rows that one search takes; longer conversations are chained
BLOCK = 256

#: states: nothing written, system turn, user turn, assistant turn
NEXT = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
FINAL = (0, 3)
#: what Rerole and Insert write in a state: the one of user and assistant that may follow
WRITES = {0: "user", 1: "user", 2: "assistant", 3: "user"}
AFTER = {s: NEXT[s][w[0]] for s, w in WRITES.items()}
_BLANK = " \t\n\x0b\x0c\r"

Way = tuple[int, str]


# ------------------------------------------------------------- the search
def _forward(row: tuple | None, state: int) -> Iterator[tuple[int, int, int, str]]:
    """Edges out of a node: rows read, state after, cost, letter."""
    yield 0, AFTER[state], COST[INSERT], INSERT
    if row is not None:
        initial, fault = row
        yield 1, state, COST[DELETE], DELETE
        if fault in ("", "truncated"):
            more = TRUNCATED_COST if fault else 0
            if initial in NEXT[state]:
                yield 1, NEXT[state][initial], COST[KEEP] + more, KEEP
            yield 1, AFTER[state], COST[REROLE] + more, REROLE


_INTO = {s: [p for p in AFTER if AFTER[p] == s] for s in range(4)}


def _backward(row: tuple | None, state: int) -> Iterator[tuple[int, int, int, str]]:
    """Edges into a node, ``row`` being the one before it."""
    for before in _INTO[state]:
        yield 0, before, COST[INSERT], INSERT
    if row is not None:
        initial, fault = row
        yield 1, state, COST[DELETE], DELETE
        if fault in ("", "truncated"):
            more = TRUNCATED_COST if fault else 0
            for before in range(4):
                if NEXT[before].get(initial) == state:
                    yield 1, before, COST[KEEP] + more, KEEP
            for before in _INTO[state]:
                yield 1, before, COST[REROLE] + more, REROLE


class _Side:
    """One heap and its labels: the cheapest and then least audit per node.

    Nodes of equal cost leave the heap in the direction of the search; only
    Keep costs nothing, and it moves one row on, so every label is final
    when its node leaves."""

    def __init__(self, starts: list[tuple[int, int]], reverse: bool):
        self.reverse, self.done = reverse, set()
        self.label: dict[tuple[int, int], Way] = {node: (0, "") for node in starts}
        self.heap = [(0, self._rank(i), s) for i, s in starts]
        heapq.heapify(self.heap)

    def _rank(self, i: int) -> int:
        return -i if self.reverse else i

    def least(self) -> float:
        while self.heap and (abs(self.heap[0][1]), self.heap[0][2]) in self.done:
            heapq.heappop(self.heap)
        return self.heap[0][0] if self.heap else float("inf")

    def step(self, rows: list[tuple]) -> tuple[int, int]:
        """Settle the next node and relax its edges."""
        cost, rank, state = heapq.heappop(self.heap)
        node = i, _ = abs(rank), state
        self.done.add(node)
        audit = self.label[node][1]
        if self.reverse:
            edges = _backward(rows[i - 1] if i else None, state)
        else:
            edges = _forward(rows[i] if i < len(rows) else None, state)
        for moved, to, more, letter in edges:
            j = i - moved if self.reverse else i + moved
            way = cost + more, letter + audit if self.reverse else audit + letter
            old = self.label.get((j, to))
            if old is None or way < old:
                self.label[j, to] = way
                if old is None or way[0] < old[0]:
                    heapq.heappush(self.heap, (way[0], self._rank(j), to))
        return node


def search(rows: list[tuple], start: int = 0, ends: tuple[int, ...] = FINAL) -> Way | None:
    """Cheapest, then ASCII-least audit from ``start`` before the rows to one of
    the states ``ends`` after them; rows are (role initial, fault)."""
    ahead, back = _Side([(0, start)], False), _Side([(len(rows), e) for e in ends], True)
    best = float("inf")
    while True:
        f, b = ahead.least(), back.least()
        if f + b > best or f + b == float("inf"):
            break
        side, other = (ahead, back) if f <= b else (back, ahead)
        node = side.step(rows)
        if node in other.label:
            best = min(best, side.label[node][0] + other.label[node][0])
    crossings = [(c + back.label[v][0], a + back.label[v][1]) for v, (c, a) in ahead.label.items() if v in back.label]
    return min(crossings) if crossings else None


def chained(first: dict, then: dict) -> dict:
    """Ways through two stretches of rows, from the ways through each."""
    out: dict[tuple[int, int], Way] = {}
    for (s, m), (c, a) in first.items():
        for (n, e), (d, b) in then.items():
            if n == m and ((s, e) not in out or (c + d, a + b) < out[s, e]):
                out[s, e] = c + d, a + b
    return out


def ways(rows: list[tuple], starts=range(4), ends=range(4)) -> dict:
    """The best way through one block for each state before and after it."""
    found = {(s, e): search(rows, s, (e,)) for s in starts for e in ends}
    return {k: w for k, w in found.items() if w is not None}


# ------------------------------------------------------- rows and faults
def _shown(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(" "))


def damage(turns: DataFrame) -> DataFrame:
    """``conversations`` rows as damaged by crc32 of ``conv_id:turn`` modulo 20:
    0 drops, 1 empties the text, 2 removes its ``.!?``, 3 repeats, 4 sets role user."""
    kind = F.crc32(F.concat(_shown("conv_id"), F.lit(":"), _shown("turn")).cast("binary")) % 20
    rows = turns.select("conv_id", "turn", kind.alias("_kind"), _shown("role").alias("role"), _shown("text").alias("text")).where("_kind <> 0")
    text = F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return (rows.withColumn("_again", F.explode(F.when(F.col("_kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
            .select("conv_id", "turn", F.when(F.col("_kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text")))


def faults(turns: DataFrame) -> DataFrame:
    """``(_c, _turn, _role, _text, _n, _fault)``: equal rows of one turn once with
    their number, and the fault of the first of them.

    Both groupings are combined before their shuffles, so a text that a
    conversation repeats is one row a task; what is compared is its digest."""
    rows = turns.select(F.col("conv_id").alias("_c"), F.col("turn").alias("_turn"), _shown("role").alias("_role"), _shown("text").alias("_text"))
    rows = rows.withColumn("_h", F.sha2("_text", 256)).groupBy("_c", "_turn", "_role", "_h").agg(F.first("_text").alias("_text"), F.count(F.lit(1)).alias("_n"))
    order = F.struct(F.col("_turn").isNotNull().alias("_set"), "_turn")
    first = rows.groupBy(F.col("_c").alias("_c2"), F.col("_role").alias("_role2"), F.col("_h").alias("_h2")).agg(F.min(order).alias("_first"))
    match = F.col("_c").eqNullSafe(F.col("_c2")) & (F.col("_role") == F.col("_role2")) & (F.col("_h") == F.col("_h2"))
    core = F.trim(F.col("_text"), F.lit(_BLANK))
    fault = (F.when(core == "", "blank").when(~F.col("_turn").eqNullSafe(F.col("_first._turn")), "duplicate")
             .when(~F.right(core, F.lit(1)).isin(".", "!", "?"), "truncated").otherwise(""))
    return rows.join(first, match).select("_c", "_turn", "_role", "_text", "_n", fault.alias("_fault"))


# ------------------------------------------------------- pieces and chains
_COUNTS = ["blank", "duplicate", "truncated", "illegal"]
_LONG, _INT, _STRING = T.LongType(), T.IntegerType(), T.StringType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(k, t) for k, t in fields.items()])


_WAYS = T.ArrayType(_struct(start=_INT, end=_INT, cost=_LONG, audit=_STRING))
_PIECE = _struct(rows=_LONG, turns=_LONG, low=_LONG, high=_LONG, first=_STRING, last=_STRING, **dict.fromkeys(_COUNTS, _LONG), ways=_WAYS)
_PARTS = T.ArrayType(_struct(part=_INT, audit=_STRING, state=_INT, position=_LONG))


class _Piece:
    """What a run of a conversation's rows adds up to; rows come in order."""

    def __init__(self, begins: bool):
        self.rows = self.turns = 0
        self.low = self.high = self.first = self.last = None
        self.count = dict.fromkeys(_COUNTS, 0)
        self.block: list[tuple] = []
        self.starts = (0,) if begins else range(4)
        self.through: dict | None = None

    def add(self, turn: int | None, role: str, n: int, fault: str) -> None:
        initial = role[:1]
        if turn is not None and turn != self.high:
            self.turns += 1
            self.low, self.high = turn if self.low is None else self.low, turn
        if self.last is not None:
            self.count["illegal"] += self.last + initial not in ("su", "ua", "au")
        self.count["illegal"] += (n - 1) * (2 * initial not in ("su", "ua", "au"))
        self.first, self.last = initial if self.first is None else self.first, initial
        self.rows += n
        for k in range(n):   # all but the first of equal rows are duplicates, blank ones blank
            if k and fault != "blank":
                fault = "duplicate"
            if fault:
                self.count[fault] += 1
            self.block.append((initial, fault))
            if len(self.block) == BLOCK:
                self._close(range(4))

    def _close(self, ends) -> None:
        here = ways(self.block, self.starts if self.through is None else range(4), ends)
        self.through, self.block = here if self.through is None else chained(self.through, here), []

    def row(self, complete: bool) -> dict:
        if self.block:
            self._close(FINAL if complete else range(4))
        listed = [{"start": s, "end": e, "cost": c, "audit": a} for (s, e), (c, a) in self.through.items()]
        return {"rows": self.rows, "turns": self.turns, "low": self.low, "high": self.high, "first": self.first, "last": self.last, **self.count, "ways": listed}


def _solved(pieces: list[dict]) -> dict:
    """A conversation's counts, cost and audit, and for each piece its part of
    the audit with the state and the number of turns written before it."""
    total, turns, low, high, last = dict.fromkeys(_COUNTS, 0), 0, None, None, None
    at: dict[int, tuple[int, str, tuple]] = {0: (0, "", (0,))}
    for p in pieces:
        for c in _COUNTS:
            total[c] += p[c]
        if last is not None:
            total["illegal"] += last + p["first"] not in ("su", "ua", "au")
        last = p["last"]
        if p["low"] is not None:
            turns += p["turns"] - (p["low"] == high)
            low, high = p["low"] if low is None else low, p["high"]
        after: dict = {}
        for w in p["ways"]:
            if w["start"] in at:
                cost, audit, path = at[w["start"]]
                way = cost + w["cost"], audit + w["audit"], (*path, w["end"])
                after[w["end"]] = min(after.get(w["end"], way), way)
        at = after
    cost, audit, path = min(w for e, w in at.items() if e in FINAL)
    parts, position = [], 0
    for p, start, end in zip(pieces, path, path[1:]):
        own = next(w["audit"] for w in p["ways"] if (w["start"], w["end"]) == (start, end))
        parts.append({"part": p["part"], "audit": own, "state": start, "position": position})
        position += len(own) - own.count(DELETE)
    return {"gaps": 0 if low is None else high - low + 1 - turns, **total, "cost": cost, "audit": audit, "parts": parts}


def _arrow(t: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type
    return to_arrow_type(t)


def _dealt(rows: DataFrame) -> DataFrame:
    """The rows with the range (``_part``) that holds them and, after each run of a
    conversation's rows in a range, the run's piece (``_kind`` 1)."""
    # the range's key holds only the beginning of a text: sampled keys go to the driver
    order = [F.col("_c").asc_nulls_first(), F.col("_turn").asc_nulls_first(), F.col("_role")]
    names = ["_c", "_turn", "_role", "_text", "_n", "_fault"]
    schema = T.StructType([*[T.StructField(c, rows.schema[c].dataType) for c in names], T.StructField("_part", _INT), T.StructField("_kind", _INT), T.StructField("piece", _PIECE)])

    def run(batches):
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        types = [_arrow(f.dataType) for f in schema]
        piece, current, begins = None, None, False

        def closed(keys, found):
            n = len(keys)
            columns = [pa.array(keys, types[0]), *[pa.nulls(n, t) for t in types[1:6]], pa.array([part] * n, types[6]), pa.array([1] * n, types[7]), pa.array(found, types[8])]
            return pa.RecordBatch.from_arrays(columns, schema.names)

        for b in batches:
            keys, found = [], []
            for c, turn, role, n, fault in zip(*(b.column(k).to_pylist() for k in (0, 1, 2, 4, 5))):
                if piece is None or c != current:
                    if piece is not None:
                        keys.append(current)
                        found.append(piece.row(True))
                    piece, current, begins = _Piece(begins), c, True
                piece.add(turn, role, n, fault)
            n = b.num_rows
            yield pa.RecordBatch.from_arrays([*[b.column(k).cast(types[k]) for k in range(6)], pa.array([part] * n, types[6]), pa.array([0] * n, types[7]), pa.nulls(n, types[8])], schema.names)
            yield closed(keys, found)
        if piece is not None:
            yield closed([current], [piece.row(False)])

    ranged = rows.repartitionByRange(*order, F.left(F.col("_text"), F.lit(64))).sortWithinPartitions(*order, "_text")
    return ranged.select(*names).mapInArrow(run, schema)


def _report(pieces: DataFrame) -> DataFrame:
    """One row per conversation from its pieces, as many as ranges hold rows of it."""
    lists = pieces.select("_c", F.struct(F.col("_part").alias("part"), "piece.*").alias("p")).groupBy("_c").agg(F.sort_array(F.collect_list("p")).alias("p"))
    fields = _struct(gaps=_LONG, **dict.fromkeys(_COUNTS, _LONG), cost=_LONG, audit=_STRING, parts=_PARTS)
    schema = T.StructType([pieces.schema["_c"], *fields])

    def run(batches):
        for b in batches:
            found = [_solved(p) for p in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array([r[f.name] for r in found], _arrow(f.dataType)) for f in fields]], schema.names)

    return lists.mapInArrow(run, schema)


def _edited(rows: DataFrame, report: DataFrame) -> DataFrame:
    """The repaired turns: every piece's audit meets its rows, in their order."""
    head = report.select("_c", F.explode("parts").alias("p")).select("_c", F.col("p.part").alias("_part"), F.lit(0).alias("_kind"), "p.audit", "p.state", "p.position")
    body = rows.select("_c", "_part", F.lit(1).alias("_kind"), "_turn", "_role", "_text", "_n")
    both = head.unionByName(body, allowMissingColumns=True).repartition("_c", "_part").sortWithinPartitions("_c", "_part", "_kind", F.col("_turn").asc_nulls_first(), "_role", "_text")
    schema = T.StructType([rows.schema["_c"], T.StructField("position", _LONG), T.StructField("role", _STRING), T.StructField("text", _STRING)])
    names = ["_c", "_kind", "audit", "state", "position", "_role", "_text", "_n"]

    def run(batches):
        key, audit, at, state, position = None, "", 0, 0, 0
        out: list[tuple] = []

        def write(role, text):
            nonlocal state, position
            out.append((key, position, role, text))
            state, position = NEXT[state][role[0]], position + 1

        def inserts():
            nonlocal at
            while at < len(audit) and audit[at] == INSERT:
                write(WRITES[state], "")
                at += 1

        def batch():
            done = pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], _arrow(f.dataType)) for k, f in enumerate(schema)], schema.names)
            out.clear()
            return done

        for b in batches:
            for c, kind, a, s, p, role, text, n in zip(*(b.column(k).to_pylist() for k in names)):
                if kind == 0:
                    inserts()
                    key, audit, at, state, position = c, a, 0, s, p
                for _ in range(n or 0):
                    inserts()
                    letter, at = audit[at], at + 1
                    if letter != DELETE:
                        write(role if letter == KEEP else WRITES[state], text)
            yield batch()
        inserts()
        yield batch()

    return both.select(*names).mapInArrow(run, schema)


def repair(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(report, repaired)`` of rows ``conv_id, turn, role, text``: per conversation
    its faults, cost and audit; the repaired turns ``conv_id, position, role, text``."""
    dealt = written(_dealt(faults(turns)), "repair-rows", "zstd")
    report = written(_report(dealt.where("_kind = 1")), "repair-report")
    repaired = _edited(dealt.where("_kind = 0"), report)
    return report.drop("parts").withColumnRenamed("_c", "conv_id"), repaired.withColumnRenamed("_c", "conv_id")


def digests(repaired: DataFrame) -> DataFrame:
    """``(conv_id, repaired_sha256)`` over ``role:text`` lines.  One digest is one
    stream, so a conversation passes one task, turn by turn."""
    schema = T.StructType([repaired.schema["conv_id"], T.StructField("repaired_sha256", _STRING)])

    def run(batches):
        key, live = None, None
        for b in batches:
            keys, found = [], []
            for c, role, text in zip(*(b.column(k).to_pylist() for k in range(3))):
                if live is None or c != key:
                    if live is not None:
                        keys.append(key)
                        found.append(live.hexdigest())
                    key, live = c, hashlib.sha256(f"{role}:{text}".encode())
                else:
                    live.update(f"\n{role}:{text}".encode())
            yield pa.RecordBatch.from_arrays([pa.array(keys, _arrow(schema[0].dataType)), pa.array(found, pa.string())], schema.names)
        if live is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key], _arrow(schema[0].dataType)), pa.array([live.hexdigest()])], schema.names)

    return repaired.repartition("conv_id").sortWithinPartitions("conv_id", "position").select("conv_id", "role", "text").mapInArrow(run, schema)


COLUMNS = ["gaps", *_COUNTS, "cost"]


def damaged_and_repaired(turns: DataFrame) -> DataFrame:
    """The report of every conversation of ``turns`` after ``damage`` and repair,
    those that lost all rows included."""
    report, repaired = repair(damage(turns))
    every = turns.select("conv_id").distinct()
    for side in (report, digests(repaired)):
        side = side.withColumnRenamed("conv_id", "_id")
        every = every.join(side, F.col("conv_id").eqNullSafe(F.col("_id")), "left").drop("_id")
    return every.select("conv_id", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in COLUMNS], F.coalesce("audit", F.lit("")).alias("audit"),
                        F.coalesce("repaired_sha256", F.lit(sha256_hex(b""))).alias("repaired_sha256"))
