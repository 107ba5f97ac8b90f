"""Repair of conversations: the cheapest edits that make the roles follow `(s?(ua)+)?`, by rank-convergence parallel Viterbi.

1. Rows are sorted over the whole cluster by conversation, turn and a digest of role and text, and every stretch of a conversation within a
   partition is cut into chunks of codes (a byte for each row: role initial and fault).
2. Each chunk gets backward costs, the least cost from each state of the pattern to the end, from a speculative cost vector at its
   right edge. Vectors are kept relative to their least entry.
3. Fix-up passes run chunks again from what their right neighbour has found, and stop inside a chunk where the new vector differs from
   the old one only by a constant: all costs to the left of it are right already. Spans that one task fixes double with each pass, so
   that chunks that never converge need only a logarithmic number of passes. Passes end when all edges agree.
4. The stitched costs lead through each conversation from left to right: of the edits on a cheapest path the one with the
   least letter is taken. Codes, costs and texts of a conversation meet as a sorted stream.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plyforge.sources.paths import stored

CHUNK = 4096
SPACES = " \t\n\v\f\r"
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5

#: Role initials by class; a role with another initial, or an empty one, is of class 0.
INITIALS = {"s": 1, "u": 2, "a": 3}
FAULTS = (None, "blank", "duplicate", "truncated")
COPY = 16
#: States: nothing yet, after s, after u, after a. The state after each class, and what an insertion adds.
AFTER = ({1: 1, 2: 2}, {2: 2}, {3: 3}, {2: 2})
ADDED = (2, 2, 3, 2)
ROLES = {2: "user", 3: "assistant"}
LEGAL = {(1, 2), (2, 3), (3, 2)}

Costs = tuple[int, int, int, int]
#: Costs at the end of a conversation: what is open is closed by insertions.
END: Costs = (0, 2 * INSERT, INSERT, 0)


@cache
def ways(after: Costs, code: int, state: int) -> tuple[tuple[int, str, int], ...]:
    """(cost, edit, next state) of everything that can be done with a row, given the costs after it. Insertions before it are not among them."""
    kind, fault = code & 3, code >> 2 & 3
    found = [(DELETE + after[state], "D", state)]
    if fault in (0, 3):
        extra = TRUNCATED if fault else 0
        if kind in AFTER[state]:
            found.append((KEEP + extra + after[AFTER[state][kind]], "K", AFTER[state][kind]))
        found.append((REROLE + extra + after[ADDED[state]], "R", ADDED[state]))
    return tuple(found)


@cache
def before(after: Costs, code: int) -> tuple[Costs, int]:
    """Costs before a row from those after it, relative to the least, and that least one."""
    costs = [min(ways(after, code, s))[0] for s in range(4)]
    for _ in range(2):
        costs = [min(c, INSERT + costs[ADDED[s]]) for s, c in enumerate(costs)]
    least = min(costs)
    return tuple(c - least for c in costs), least


@cache
def edits(after: Costs, code: int, state: int) -> tuple[str, int]:
    """The least letters of a cheapest way over a row, insertions before it included, and the state behind it."""
    costs, least = before(after, code)
    letters = ""
    while True:
        best = {edit: there for cost, edit, there in ways(after, code, state) if cost - least == costs[state]}
        if "D" in best:
            return letters + "D", state
        if INSERT + costs[ADDED[state]] == costs[state]:
            letters, state = letters + "I", ADDED[state]
            continue
        edit = min(best)
        return letters + edit, best[edit]


def _vector(costs: bytes, i: int) -> Costs:
    return tuple(costs[4 * i:4 * i + 4])


def backward(codes: bytes, edge: Costs, known: bytes | None = None) -> bytes:
    """The cost vectors before each row and at the right edge, four bytes each.

    With `known` vectors of an earlier run it stops where both differ only by a constant, and keeps the rest.
    """
    now = edge
    if known is not None and _vector(known, len(codes)) == now:
        return known
    out = [bytes(now)]
    for i in range(len(codes) - 1, -1, -1):
        now, _ = before(now, codes[i] & 15)
        if known is not None and _vector(known, i) == now:
            return known[:4 * i + 4] + b"".join(reversed(out))
        out.append(bytes(now))
    return b"".join(reversed(out))


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) with the faults that a hash of conversation and turn deals out; null roles and texts are one blank.

    Of every twenty kinds, 0 drops the row, 1 empties the text, 2 takes its ends of sentences, 3 repeats the row, 4 makes the role user.
    """
    blank = F.lit(" ")
    own = [F.coalesce(F.col(c).cast("string"), blank) for c in ("conv_id", "turn")]
    draw = F.crc32(F.concat(own[0], F.lit(":"), own[1]).cast("binary")) % 20
    role, text = (F.coalesce(F.col(c).cast("string"), blank) for c in ("role", "text"))
    rows = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), draw.alias("draw")).where("draw != 0")
    return rows.select(
        "conv_id", "turn", F.when(F.col("draw") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("draw") == 1, "").when(F.col("draw") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.array_repeat(F.lit(0), F.when(F.col("draw") == 3, 2).otherwise(1))).alias("copy")).drop("copy")


def _with_digest(rows: DataFrame) -> DataFrame:
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    plain = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"))
    return plain.withColumn("digest", F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)))


def _coded(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, digest, n, code): one row for equal rows, with their number and the code of the first."""
    kind = F.lit(0)
    for initial, number in INITIALS.items():
        kind = F.when(F.substring("role", 1, 1) == initial, number).otherwise(kind)
    end = F.rtrim("text", F.lit(SPACES))
    narrow = rows.select("conv_id", "turn", "digest", kind.alias("kind"), (end == "").cast("int").alias("blank"),
                         (~F.right(end, F.lit(1)).isin(".", "!", "?")).cast("int").alias("cut"))
    once = stored(narrow.groupBy("conv_id", "turn", "digest").agg(
        F.count("*").alias("n"), F.max("kind").alias("kind"), F.max("blank").alias("blank"), F.max("cut").alias("cut")), "turns")
    # The few texts that a conversation has at more than one turn, with the first of these turns; null comes before all.
    again = once.groupBy(F.col("conv_id").alias("c"), F.col("digest").alias("d")).agg(
        F.count("*").alias("k"), F.min("turn").alias("first"), F.max(F.col("turn").isNull().cast("int")).alias("unnumbered")).where("k > 1")
    seen = F.col("k").isNotNull() & F.col("turn").isNotNull() & ((F.col("unnumbered") == 1) | (F.col("turn") > F.col("first")))
    fault = F.when(F.col("blank") == 1, 1).when(seen, 2).when(F.col("cut") == 1, 3).otherwise(0)
    return once.join(again, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("digest") == F.col("d")), "left").select(
        "conv_id", "turn", "digest", "n", (F.col("kind") + 4 * fault).cast("int").alias("code"))


ORDER = ["conv_id", "turn", "digest"]


def _types(df: DataFrame) -> str:
    return ", ".join(f"{c} {df.schema[c].dataType.simpleString()}" for c in ("conv_id", "turn"))


def _chunks(coded: DataFrame, size: int) -> DataFrame:
    """(conv_id, turn, digest of the first row, part, k, codes, r, chunks): r counts a conversation's chunks from the right, from 0."""
    ranged = coded.repartitionByRange(*ORDER).sortWithinPartitions(*ORDER)
    names = [*ORDER, "part", "k", "codes"]
    schema = f"{_types(coded)}, digest binary, part int, k long, codes binary"
    kinds = None

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nonlocal kinds
        part, k, codes, key, out = TaskContext.get().partitionId(), 0, bytearray(), None, []

        def close() -> None:
            nonlocal k
            out.append((*key, part, k, bytes(codes)))
            codes.clear()
            k += 1

        def taken() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) or [()] * 6
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)

        for batch in batches:
            kinds = [batch.column("conv_id").type, batch.column("turn").type, pa.binary(), pa.int32(), pa.int64(), pa.binary()]
            for conv, turn, digest, n, code in zip(*(batch.column(c).to_pylist() for c in (*ORDER, "n", "code")), strict=True):
                if codes and (conv != key[0] or len(codes) >= size):
                    close()
                if not codes:
                    key = (conv, turn, digest)
                codes.append(code)
                # Equal rows are one turn and its copies: blank like it, else duplicates.
                copy, left = (code & 3) + 4 * (1 if code >> 2 == 1 else 2) + COPY, n - 1
                while left:
                    if len(codes) >= size:
                        close()
                        key = (conv, turn, digest)
                    more = min(left, size - len(codes))
                    codes.extend(bytes([copy]) * more)
                    left -= more
            yield taken()
        if codes:
            close()
            yield taken()

    # One row for 4,096 turns comes together here.
    own = Window.partitionBy("conv_id")
    cuts = stored(ranged.mapInArrow(cut, schema), "chunks")
    return cuts.withColumn("r", F.row_number().over(own.orderBy(F.desc("part"), F.desc("k"))) - 1).withColumn("chunks", F.count("*").over(own))


def _solved(chunks: DataFrame) -> DataFrame:
    """Chunks with `costs`, all edges in agreement."""
    fields = [f for f in chunks.schema.fields if f.name != "costs"]
    names = [f.name for f in fields]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fields) + ", costs binary"

    def speculate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            costs = [backward(c, END) for c in batch.column("codes").to_pylist()]
            yield pa.RecordBatch.from_arrays([*map(batch.column, names), pa.array(costs, pa.binary())], [*names, "costs"])

    def fix(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span, head = None, b""
        for batch in batches:
            out = []
            columns = (batch.column(c).to_pylist() for c in ("conv_id", "span", "codes", "costs", "right"))
            for conv, number, codes, costs, right in zip(*columns, strict=True):
                edge = head if span == (conv, number) else right
                costs = backward(codes, END if edge is None else tuple(edge), costs)
                span, head = (conv, number), costs[:4]
                out.append(costs)
            yield pa.RecordBatch.from_arrays([*map(batch.column, names), pa.array(out, pa.binary())], [*names, "costs"])

    first = stored(chunks.mapInArrow(speculate, schema), "costs")
    single, many = first.where("chunks = 1"), first.where("chunks > 1")
    right = F.lag(F.substring("costs", 1, 4)).over(Window.partitionBy("conv_id").orderBy("r"))
    edge = F.substring("costs", 4 * F.length("codes") + 1, F.lit(4))
    width = 1
    while True:
        seen = stored(many.withColumn("right", right), "edges")
        if seen.where(F.col("right").isNotNull() & (F.col("right") != edge)).isEmpty():
            return single.unionByName(many)
        spans = seen.withColumn("span", F.floor(F.col("r") / width))
        many = stored(spans.repartition("conv_id", "span").sortWithinPartitions("conv_id", "span", "r").mapInArrow(fix, schema), "costs")
        width *= 2


def repaired_turns(conversations: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """The edits of every conversation: conv_id, edit (K, R, D, I), role and text afterwards (null if deleted), turn, kind, fault, cost.

    A conversation's rows follow each other, in order, in one partition. `kind` is the class of the initial before the edit.
    Rows of equal turn are ordered by a digest of role and text. A null conv_id is one conversation, a null turn comes first, a null role or text counts as
    one blank, so such a text is blank; an empty role fits nowhere and is reroled or deleted. Repeated rows are duplicates of the first. Long texts
    and conversations are streamed. An empty table gives no rows; other columns are not looked at.
    """
    rows = _with_digest(conversations)
    solved = _solved(_chunks(_coded(rows), chunk))
    texts = rows.groupBy(*ORDER).agg(F.first("role").alias("role"), F.first("text").alias("text"))
    both = solved.select(*ORDER, F.lit(0).alias("what"), "part", "k", "codes", "costs", "r").unionByName(
        texts.select(*ORDER, F.lit(1).alias("what"), "role", "text"), allowMissingColumns=True)
    stream = both.repartition("conv_id").sortWithinPartitions(*ORDER, "what", "part", "k")
    names = ["conv_id", "turn", "edit", "role", "text", "kind", "fault", "cost"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, state, last = object(), 0, False
        waiting: deque[tuple[str, int, int]] = deque()  # (edits, state before, code) of the rows of the chunks at hand

        def done(turn, role, text) -> Iterator[tuple]:
            """The edits of the next row, and of its copies as far as chunks have come."""
            letters, at, code = waiting.popleft()
            for letter in letters:
                if letter == "I":
                    at = ADDED[at]
                    yield conv, None, "I", ROLES[at], "", None, None, INSERT
                    continue
                kind, fault = code & 3, code >> 2 & 3
                extra = TRUNCATED if fault == 3 and letter != "D" else 0
                if letter == "R":
                    at = ADDED[at]
                cost = {"K": KEEP, "R": REROLE, "D": DELETE}[letter] + extra
                shown = {"K": (role, text), "R": (ROLES.get(at), text), "D": (None, None)}[letter]
                yield conv, turn, letter, *shown, kind, FAULTS[fault], cost
            while waiting and waiting[0][2] & COPY:
                _, _, code = waiting.popleft()
                yield conv, turn, "D", None, None, code & 3, FAULTS[code >> 2 & 3], DELETE

        def closed() -> Iterator[tuple]:
            at = state
            while last and not waiting and at in (1, 2):
                at = ADDED[at]
                yield conv, None, "I", ROLES[at], "", None, None, INSERT

        def taken(out: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) or [()] * len(names)
            kinds = [*types, pa.string(), pa.string(), pa.string(), pa.int32(), pa.string(), pa.int32()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)

        types = None
        for batch in batches:
            types = batch.column("conv_id").type, batch.column("turn").type
            out: list[tuple] = []
            columns = (batch.column(c).to_pylist() for c in ("conv_id", "turn", "what", "codes", "costs", "r", "role", "text"))
            for own, turn, what, codes, costs, r, role, text in zip(*columns, strict=True):
                if own != conv:
                    out += closed()
                    conv, state, last = own, 0, False
                if what == 0:
                    for i, code in enumerate(codes):
                        letters, there = edits(_vector(costs, i + 1), code & 15, state)
                        waiting.append((letters, state, code))
                        state = there
                    last = r == 0
                else:
                    out += done(turn, role, text)
                if len(out) > 4096:
                    yield taken(out)
                    out = []
            yield taken(out)
        if types:
            yield taken(list(closed()))

    return stream.mapInArrow(
        run, f"{_types(conversations)}, edit string, role string, text string, kind int, fault string, cost int")


def repair_digests(conversations: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """What op12 returns, from the edits of the damaged conversations; a conversation that lost all its rows has zeros and an empty audit.

    The hash of a conversation needs its turns one after the other, so they are streamed through one task; only the audit, which is
    a value of the result, is held whole.
    """
    found = repaired_turns(damaged(conversations), chunk)
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    names = ["conv_id", *counts, "audit", "repaired_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, one = object(), None
        types = None

        def taken(out: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) or [()] * len(names)
            kinds = [types, *[pa.int64()] * len(counts), pa.string(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)

        for batch in batches:
            types, out = batch.column("conv_id").type, []
            columns = (batch.column(c).to_pylist() for c in ("conv_id", "turn", "edit", "role", "text", "kind", "fault", "cost"))
            for own, *row in zip(*columns, strict=True):
                if own != conv or one is None:
                    if one is not None:
                        out.append((conv, *one.result()))
                    conv, one = own, _Summary()
                one.add(*row)
            yield taken(out)
        if one is not None:
            yield taken([(conv, *one.result())])

    kind = conversations.schema["conv_id"].dataType.simpleString()
    schema = ", ".join([f"conv_id {kind}", *[f"{c} long" for c in counts], "audit string", "repaired_sha256 string"])
    digests = found.mapInArrow(run, schema)
    ids = conversations.select(F.col("conv_id").alias("id")).distinct()
    nothing = {**dict.fromkeys(counts, F.lit(0).cast("long")), "audit": F.lit(""), "repaired_sha256": F.lit(hashlib.sha256().hexdigest())}
    return ids.join(digests, F.col("id").eqNullSafe(F.col("conv_id")), "left").select(
        F.col("id").alias("conv_id"), *[F.coalesce(F.col(c), v).alias(c) for c, v in nothing.items()])


class _Summary:
    """Running counts over the edits of a conversation."""

    def __init__(self) -> None:
        self.faults = dict.fromkeys(FAULTS[1:], 0)
        self.illegal = self.cost = self.turns = 0
        self.low = self.high = self.kind = None
        self.audit: list[str] = []
        self.hash, self.begun = hashlib.sha256(), False

    def add(self, turn, edit, role, text, kind, fault, cost) -> None:
        self.audit.append(edit)
        self.cost += cost
        if edit != "I":
            if fault:
                self.faults[fault] += 1
            self.illegal += self.kind is not None and (self.kind, kind) not in LEGAL
            self.kind = kind
            if turn is not None and turn != self.high:
                self.turns, self.low, self.high = self.turns + 1, turn if self.low is None else self.low, turn
        if edit != "D":
            self.hash.update(("\n" * self.begun + f"{role}:{text}").encode())
            self.begun = True

    def result(self) -> tuple:
        gaps = 0 if self.low is None else min(self.high - self.low + 1 - self.turns, 2 ** 63 - 1)
        return (gaps, *self.faults.values(), self.illegal, self.cost, "".join(self.audit), self.hash.hexdigest())
