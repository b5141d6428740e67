"""Repair of the structure of conversations at least cost, by rank-convergence parallel Viterbi.

A repaired conversation's role initials read ``(s?(ua)+)?``. Rows are kept (0), re-roled to user or
assistant (2) or deleted (3, forced for blank and repeated rows); empty user or assistant messages are
inserted anywhere (2 each); every truncated row that is not deleted adds 1. Of the cheapest edit sequences
the one whose initials (D, I, K, R) come first in ASCII order is taken.

States: nothing yet, after s, after u, after a. The Viterbi vector at a row holds the least cost to go from
each state. From one state all letters lead to one next state each, so the least sequence is read off by
taking, at every step, the first letter that is on a cheapest path.

* Rows are sorted into ranges by (conversation, turn), so a conversation of any size is spread over tasks. Those
  that lie wholly inside one task and one chunk are repaired there, in one pass. The others (at most two for
  each task, and the long ones) leave as chunks of at most ``CHUNK_ROWS`` rows and about ``CHUNK_BYTES``.
* Their chunks run backwards in parallel, each from a speculative vector at its right end. Fix-up passes then
  rerun the chunks whose right neighbour came out with another vector than was assumed, until vectors
  differ only by constants (vectors are kept with their least entry at 0, so equal ones). A vector's entries
  are at most 4 apart, since inserts lead from any state to any later one, and a clean stretch of rows makes all
  of them alike: normally one pass is enough. Rows that never converge (a long row of foreign roles) get, after
  ``FIXUPS`` passes, the vectors by the chunks' transfer matrices (16 numbers for a chunk), which are
  streamed from right to left.
* The stitched backward vectors drive the trace, which goes forward through a conversation's chunks; there the
  texts are hashed. A SHA-256 of a whole conversation can only be taken in order, so its chunks are
  streamed through one task, one at a time.

Damage (``damaged``) is the contract's. Defined cases: null conv_id is a conversation of its own; a null turn, role
or text counts as one space in the damage key, and role and text as one space; rows of equal turn come in the
order of the SHA-256 of role and text; a conversation without rows left has zeros, an empty audit and the hash
of the empty text. Roles other than system, user, assistant count by their first character, case kept. Turns
that are no whole numbers are null; gaps beyond long are held at its end. Empty table: empty result. Extra
columns are ignored.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickvault.llm.common import drop_stages, ship, stage

ship(__name__)

CHUNK_ROWS, CHUNK_BYTES, FIXUPS = 4096, 1 << 20, 4
DELETE, INSERT, REROLE, CUT = 3, 2, 2, 1
BLANKS = " \t\n\x0b\x0c\r"
#: The state after a message with this initial, where it may stand.
NEXT = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
#: The state after an inserted or re-roled message: the only role that may stand there.
TURN = (2, 2, 3, 2)
ROLE = ("user", "user", "assistant", "user")
#: Least cost to go after the last row (inserts only), and an entry that is no way at all.
END, FAR = (0, 4, 2, 0), 1 << 30
FORCED = "-"
COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_before: dict = {}
_edits: dict = {}


def code(role: str, fault: str) -> str:
    """What matters of a row to the search: must it go, its initial, is it truncated."""
    if fault in ("blank", "duplicate"):
        return FORCED
    initial = role[:1] if role[:1] in NEXT else "x"
    return initial.upper() if fault == "truncated" else initial


def fault_of(text: str) -> str:
    """blank, truncated or none (a repeat is seen against other rows)."""
    end = text.rstrip(BLANKS)
    return "blank" if not end else "" if end[-1] in ".!?" else "truncated"


def choices(c: str, state: int) -> list[tuple[str, int, int]]:
    """(letter, cost, next state) of the edits that use up a row, in order of their letters."""
    out = [("D", DELETE, state)]
    if c != FORCED:
        cut = CUT if c.isupper() else 0
        to = NEXT.get(c.lower(), {}).get(state)
        out += [("K", cut, to)] * (to is not None) + [("R", REROLE + cut, TURN[state])]
    return out


def before(c: str, after: tuple) -> tuple[tuple, int]:
    """The vector before a row from the one after it: (vector with least entry 0, constant)."""
    known = _before.get((c, after))
    if known is None:
        v = [min(cost + after[to] for _, cost, to in choices(c, s)) for s in range(4)]
        for _ in range(3):
            v = [min(v[s], INSERT + v[TURN[s]]) for s in range(4)]
        low = min(v)
        known = _before[c, after] = (tuple(min(x - low, FAR) for x in v), low)
    return known


def edits(c: str, after: tuple, state: int) -> tuple[str, int]:
    """The least letters on a cheapest path from ``state`` until the row is used up, and the next state."""
    known = _edits.get((c, after, state))
    if known is None:
        (v, low), letters, s = before(c, after), "", state
        while True:
            step = [(x, to) for x, cost, to in choices(c, s) if cost + after[to] == v[s] + low]
            if INSERT + v[TURN[s]] == v[s]:
                step.append(("I", TURN[s]))
            letter, s = min(step)
            letters += letter
            if letter != "I":
                break
        known = _edits[c, after, state] = (letters, s)
    return known


def run_back(codes: str, after: tuple) -> tuple:
    """The vector before the first row, least entry 0."""
    for c in reversed(codes):
        after = before(c, after)[0]
    return after


def transfer(codes: str) -> list[int]:
    """The 4 x 4 matrix that takes any vector after the rows to the one before them (less a constant)."""
    columns = []
    for s in range(4):
        v, total = tuple(0 if i == s else FAR for i in range(4)), 0
        for c in reversed(codes):
            v, low = before(c, v)
            total += low
        columns.append([min(FAR, x + total) if x < FAR else FAR for x in v])
    low = min(x for col in columns for x in col)
    return [min(FAR, columns[j][i] - low) if columns[j][i] < FAR else FAR for i in range(4) for j in range(4)]


def apply(matrix: list[int], after: tuple) -> tuple:
    v = [min(matrix[4 * i + j] + after[j] for j in range(4)) for i in range(4)]
    return tuple(x - min(v) for x in v)


class Repair:
    """One conversation, repaired chunk by chunk in order."""

    def __init__(self) -> None:
        self.state, self.audit, self.sha, self.lines = 0, [], hashlib.sha256(), 0
        self.count = dict.fromkeys(COUNTS, 0)
        self.initial, self.low, self.high, self.turns, self.turn = None, None, None, 0, None

    def line(self, role: str, text: str) -> None:
        self.sha.update(f"{chr(10) * (self.lines > 0)}{role}:{text}".encode("utf-8", "surrogatepass"))
        self.lines += 1

    def insert(self, n: int) -> None:
        for _ in range(n):
            self.line(ROLE[self.state], "")
            self.state = TURN[self.state]
        self.count["cost"] += INSERT * n

    def add(self, turns: list, roles: list[str], texts: list[str], faults: list[str], after: tuple) -> None:
        codes = [code(r, f) for r, f in zip(roles, faults)]
        vectors = [after]                                                # after the last row, ..., after the first
        for c in reversed(codes[1:]):
            vectors.append(before(c, vectors[-1])[0])
        for turn, role, text, fault, c, v in zip(turns, roles, texts, faults, codes, reversed(vectors)):
            self.seen(turn, role, fault)
            letters, _ = edits(c, v, self.state)
            self.audit.append(letters)
            self.insert(len(letters) - 1)
            if letters[-1] == "D":
                self.count["cost"] += DELETE
                continue
            self.count["cost"] += CUT * (fault == "truncated") + REROLE * (letters[-1] == "R")
            self.line(role if letters[-1] == "K" else ROLE[self.state], text)
            self.state = NEXT[role[0]][self.state] if letters[-1] == "K" else TURN[self.state]

    def seen(self, turn, role: str, fault: str) -> None:
        if fault:
            self.count[fault] += 1
        if self.initial is not None and self.initial + role[:1] not in ("su", "ua", "au"):
            self.count["illegal"] += 1
        self.initial = role[:1]
        if turn is not None:                                             # turns come in order
            self.turns += turn != self.turn
            self.turn = turn
            self.low = turn if self.low is None else self.low
            self.high = turn

    def result(self) -> dict:
        while END[self.state]:
            self.audit.append("I")
            self.insert(1)
        if self.low is not None:
            self.count["gaps"] = min(self.high - self.low + 1 - self.turns, 2**63 - 1)
        return {**self.count, "audit": "".join(self.audit), "repaired_sha256": self.sha.hexdigest()}


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, tie, role, text, dropped): the contract's damage by the crc32 of ``conv_id:turn``. Dropped rows
    stay as marks without role and text, so that a conversation without other rows is not lost."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", space("role").alias("role"), space("text").alias("text"), kind.alias("kind"))
    whole = F.col("turn").try_cast("long").alias("turn")
    rows = rows.select("conv_id", whole, F.sha2(F.concat("role", F.lit("\0"), "text"), 256).alias("tie"), "role", "text", "kind")
    rows = rows.withColumn("copy", F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    left = lambda c: F.when(F.col("kind") != 0, c)
    return rows.select("conv_id", "turn", "tie", left(F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))).alias("role"),
                       left(text).alias("text"), (F.col("kind") == 0).alias("dropped"))


_RESULT = ", ".join(f"{c} bigint" for c in COUNTS) + ", audit string, repaired_sha256 string"
_CHUNK = "at bigint, turns array<bigint>, roles array<string>, texts array<string>, keys array<binary>"


def _arrow(rows: list[dict], schema: T.StructType) -> pa.RecordBatch:
    from pyspark.sql.pandas.types import to_arrow_schema
    return pa.RecordBatch.from_pylist(rows, to_arrow_schema(schema))


def _faults(roles: list[str], texts: list[str]) -> list[str]:
    """First faults of a whole conversation's rows."""
    seen, out = set(), []
    for row in zip(roles, texts):
        fault = fault_of(row[1])
        out.append("duplicate" if fault != "blank" and row in seen else fault)
        seen.add(row)
    return out


def _sorted_chunks(rows: DataFrame) -> DataFrame:
    """Results of the conversations that end inside a task, and chunks (``at`` not null) of the others."""
    conv = rows.schema["conv_id"].dataType
    schema = T.StructType([T.StructField("conv_id", conv)] + T._parse_datatype_string(f"{_RESULT}, {_CHUNK}").fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, done = TaskContext.get().partitionId() << 32, 0
        conv_id, started, is_open, size = None, False, True, 0           # the first conversation may have begun in another task
        turns, roles, texts, out = [], [], [], []

        def chunk() -> dict:
            keys = [hashlib.blake2b(f"{len(r)}:{r}{t}".encode("utf-8", "surrogatepass"), digest_size=16).digest() for r, t in zip(roles, texts)]
            return {"conv_id": conv_id, "at": base + done, "turns": turns, "roles": roles, "texts": texts, "keys": keys}

        def whole() -> dict:
            one = Repair()
            one.add(turns, roles, texts, _faults(roles, texts), END)
            return {"conv_id": conv_id, **one.result()}
        for batch in batches:
            for r in batch.to_pylist():
                new = not started or r["conv_id"] != conv_id
                if started and (new or len(roles) >= CHUNK_ROWS or size >= CHUNK_BYTES):
                    is_open |= not new
                    out.append(chunk() if is_open else whole())
                    done += 1
                    turns, roles, texts, size = [], [], [], 0
                    is_open &= not new
                conv_id, started = r["conv_id"], True
                if not r["dropped"]:
                    turns.append(r["turn"])
                    roles.append(r["role"])
                    texts.append(r["text"])
                    size += len(r["text"]) + len(r["role"])
                if len(out) >= 64:
                    yield _arrow(out, schema)
                    out = []
        if started:
            out.append(chunk())                                          # the last one may go on in another task
        if out:
            yield _arrow(out, schema)
    order = ["conv_id", "turn", "tie", "__n"]                            # __n: rows alike in all others are dealt out too
    rows = rows.withColumn("__n", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order)
    return rows.select("conv_id", "turn", "role", "text", "dropped").mapInArrow(run, schema)


def _with_faults(chunks: DataFrame) -> DataFrame:
    """Chunks with ``firsts``: the places of rows that no earlier row of the conversation equals."""
    each = chunks.select("conv_id", "at", F.posexplode("keys").alias("pos", "key"))
    first = each.groupBy("conv_id", "key").agg(F.min(F.struct("at", "pos")).alias("first"))
    firsts = first.groupBy(F.col("first.at").alias("at")).agg(F.collect_list("first.pos").alias("firsts"))   # at most a chunk's rows
    return chunks.drop("keys").join(firsts, "at", "left").withColumn("firsts", F.coalesce("firsts", F.array().cast("array<int>")))


def _chunk_faults(roles: list[str], texts: list[str], firsts) -> list[str]:
    kept = set(firsts)
    return [f if f == "blank" or i in kept else "duplicate" for i, f in enumerate(map(fault_of, texts))]


def _per_chunk(chunks: DataFrame, fn, field: str) -> DataFrame:
    """``chunks`` with ``field`` = fn(row)."""
    schema = T.StructType(chunks.schema.fields + T._parse_datatype_string(field).fields)
    name = schema.fieldNames()[-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            value = pa.array([fn(r) for r in batch.to_pylist()], _arrow([], schema).schema.field(name).type)
            yield pa.RecordBatch.from_arrays([*batch.columns, value], names=schema.fieldNames())
    return chunks.mapInArrow(run, schema)


def _vector(v: tuple) -> Column:
    return F.array(*[F.lit(x) for x in v])


def settled(codes: DataFrame, spent: list[str], fixups: int = FIXUPS) -> DataFrame:
    """(at, after): the vector after the last row of every chunk. ``codes``: (conv_id, at, codes)."""
    follows = F.lead("at").over(Window.partitionBy("conv_id").orderBy("at"))   # one row for each chunk, without texts
    linked = stage(codes.select("conv_id", "at", follows.alias("next"), "codes"), "repair-codes", spent)
    back = lambda df: _per_chunk(df, lambda r: list(run_back(r["codes"], tuple(r["after"]))), "before array<int>")
    now = stage(back(linked.withColumn("after", _vector(END))).drop("codes"), "repair-vectors", spent)
    for left in range(fixups, -1, -1):
        right = now.select(F.col("at").alias("next"), F.col("before").alias("wanted"))
        now = now.join(right, "next", "left").withColumn("wanted", F.coalesce("wanted", _vector(END)))
        wrong = F.col("wanted") != F.col("after")
        stale = now.filter(wrong).select("at", F.col("wanted").alias("after"))
        if stale.isEmpty():
            return now.select("at", "after")
        if left:
            again = back(linked.join(stale, "at")).select("conv_id", "at", "next", "after", "before")
            now = stage(now.filter(~wrong).select("conv_id", "at", "next", "after", "before").unionByName(again), "repair-vectors", spent)
    return _by_matrices(linked)


def _by_matrices(codes: DataFrame) -> DataFrame:
    """(at, after) without speculation, for conversations whose vectors do not converge."""
    moves = _per_chunk(codes.select("conv_id", "at", "codes"), lambda r: transfer(r["codes"]), "matrix array<int>").drop("codes")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv_id, started, v = None, False, END
        for batch in batches:
            ats, out = [], []
            for r in batch.to_pylist():
                if not started or r["conv_id"] != conv_id:
                    conv_id, started, v = r["conv_id"], True, END
                ats.append(r["at"])
                out.append(list(v))
                v = apply(r["matrix"], v)
            yield pa.RecordBatch.from_arrays([pa.array(ats, pa.int64()), pa.array(out, pa.list_(pa.int32()))], names=["at", "after"])
    return moves.repartition("conv_id").sortWithinPartitions("conv_id", F.desc("at")).mapInArrow(run, "at bigint, after array<int>")


def _stitched(chunks: DataFrame) -> DataFrame:
    """One result for each conversation, from its chunks in order, one at a time."""
    schema = T.StructType([chunks.schema["conv_id"]] + T._parse_datatype_string(_RESULT).fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv_id, one = None, None
        for batch in batches:
            out = []
            for i in range(batch.num_rows):
                r = batch.slice(i, 1).to_pylist()[0]
                if one is None or r["conv_id"] != conv_id:
                    out += [{"conv_id": conv_id, **one.result()}] if one else []
                    conv_id, one = r["conv_id"], Repair()
                one.add(r["turns"], r["roles"], r["texts"], _chunk_faults(r["roles"], r["texts"], r["firsts"]), tuple(r["after"]))
            if out:
                yield _arrow(out, schema)
        if one:
            yield _arrow([{"conv_id": conv_id, **one.result()}], schema)
    return chunks.repartition("conv_id").sortWithinPartitions("conv_id", "at").mapInArrow(run, schema)


def repair(rows: DataFrame, fixups: int = FIXUPS) -> DataFrame:
    """(conv_id, counts, audit, repaired_sha256) of every conversation in ``rows``, as ``damaged`` gives them."""
    spark, spent = rows.sparkSession, []
    try:
        parts = stage(_sorted_chunks(rows), "repair-parts", spent)
        closed = parts.filter(F.col("at").isNull()).select("conv_id", *COUNTS, "audit", "repaired_sha256")
        chunks = parts.filter(F.col("at").isNotNull()).select("conv_id", "at", "turns", "roles", "texts", "keys")
        chunks = stage(_with_faults(chunks), "repair-chunks", spent)
        codes = _per_chunk(chunks, lambda r: "".join(map(code, r["roles"], _chunk_faults(r["roles"], r["texts"], r["firsts"]))), "codes string")
        after = settled(codes.select("conv_id", "at", "codes"), spent, fixups)
        return stage(closed.unionByName(_stitched(chunks.join(after, "at"))), "repair-results")
    finally:
        drop_stages(spark, spent)


def repair_digest(conversations: DataFrame) -> DataFrame:
    """Every conversation of the table after the contract's damage, repaired."""
    return repair(damaged(conversations))
