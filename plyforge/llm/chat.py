"""Chat transcripts: speakers are recovered with a hidden Markov model over lines, then turns are put into one format.

A hidden state is a role and whether the line begins a turn or goes on with it. A line shows its speaker marker, whether the line
before was blank, how long it is, and whether it asks. Probabilities are counts over labelled conversations.

Lines are sorted over the whole cluster by conversation and place, and each stretch of a conversation within a partition is cut into blocks.
Viterbi runs on blocks: a block is reduced to the best score between any first and last state, the few block matrices of a
conversation are folded to find the states at the borders, and each block is then decoded between its borders. The
result is the one of a single pass, and no task holds a whole conversation.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plyforge.sources.paths import stored

ROLES = ("system", "user", "assistant")
STATES = len(ROLES) * 2  # role * 2 + (1 if the line goes on with a turn)
BLOCK_LINES = 2048
LINES_PER_PART = 65_536
BLOCK_KEY = ("conv_id", "part", "block")

#: Words that name a role in front of a line. Fixed values.
NAMES = {
    "system": ("system", "instruction", "instructions", "context"),
    "user": ("user", "human", "q", "question", "customer", "me", "prompter"),
    "assistant": ("assistant", "ai", "a", "answer", "bot", "agent", "model"),
}
_ROLE_OF = {name: i for i, role in enumerate(ROLES) for name in NAMES[role]}
_MARKER = re.compile(
    r"^\s*(?:\[[0-9:. -]+\]\s*)?(?:<\|(?P<tag>\w+)\|>|#{1,4}\s*(?P<head>\w+)\s*:?\s*$|(?P<name>\w+)\s*(?::(?!//)|>)\s?)", re.ASCII)
MARKERS = len(ROLES) + 2  # a role, another name, none
SYMBOLS = MARKERS * 2 * 3 * 2

#: Styles in which `as_transcript` writes the three roles. Fixed values.
STYLES = (
    ("System: ", "User: ", "Assistant: "),
    ("Instruction: ", "Human: ", "AI: "),
    ("Context: ", "Q: ", "A: "),
    ("<|system|>", "<|user|>", "<|assistant|>"),
    ("[12:03] system> ", "[12:03] user> ", "[12:04] assistant> "),
    ("### System\n", "### User\n", "### Assistant\n"),
)
UNMARKED = 8


def marker(line: str) -> tuple[int, int]:
    """The marker class of a line and where its text begins: 0 to 2 for a role, 3 for another name, 4 for none."""
    found = _MARKER.match(line)
    if not found:
        return MARKERS - 1, 0
    name = (found["tag"] or found["head"] or found["name"]).lower()
    role = _ROLE_OF.get(name, MARKERS - 2)
    # Any word may stand before a colon; only the known ones are cut off.
    return role, found.end() if role < len(ROLES) else 0


def symbol(line: str, after_blank: bool) -> int:
    """The number of what a line shows."""
    length = 0 if len(line) < 60 else 1 if len(line) < 240 else 2
    return ((marker(line)[0] * 2 + after_blank) * 3 + length) * 2 + line.rstrip().endswith("?")


def as_transcript(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, piece, role, line): conversations written as transcripts, with the role kept beside for fitting and tests.

    The style follows from a hash of conv_id; one turn in `UNMARKED` has no marker; a blank line stands between turns. A null text is an empty
    line. Rows that are the same in conv_id, turn, role and text are one turn.
    """
    once = conversations.select(
        "conv_id", "turn", F.col("role").cast("string").alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).distinct()
    style = F.pmod(F.xxhash64("conv_id"), F.lit(len(STYLES)))
    mark: Column = F.lit("")
    for k, marks in enumerate(STYLES):
        for role, text in zip(ROLES, marks, strict=True):
            mark = F.when((style == k) & (F.col("role") == role), text).otherwise(mark)
    bare = F.pmod(F.xxhash64("conv_id", "turn"), F.lit(UNMARKED)) == 0
    text = F.concat(F.when(bare, "").otherwise(mark), "text", F.lit("\n"))
    return once.select("conv_id", "turn", "role", F.posexplode(F.split(text, "\n")).alias("piece", "line"))


def with_symbols(lines: DataFrame, order: list[str], keep: list[str]) -> DataFrame:
    """Sorts lines by conv_id and `order`, gives each its partition, place and symbol, and stores them.

    The first line of a partition counts as not after a blank one unless it begins its conversation.
    """
    parts = max(1, -(-lines.count() // LINES_PER_PART))
    columns = list(dict.fromkeys(["conv_id", *order, *keep]))
    ranged = lines.select(*columns, F.coalesce("line", F.lit("")).alias("line")).repartitionByRange(
        parts, "conv_id", *order).sortWithinPartitions("conv_id", *order).withColumn("part", F.spark_partition_id())
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ranged.schema.fields) + ", place long, symbol int"

    def show(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, blank, conv = 0, False, object()
        for batch in batches:
            symbols = []
            for own, line in zip(batch.column("conv_id").to_pylist(), batch.column("line").to_pylist(), strict=True):
                blank = blank if own == conv else True
                conv = own
                symbols.append(symbol(line, blank))
                blank = not line.strip()
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.arange(place, place + len(symbols))), pa.array(symbols, pa.int32())],
                [*batch.schema.names, "place", "symbol"])
            place += len(symbols)

    return stored(ranged.mapInArrow(show, schema), "lines")


class Model:
    """Log probabilities of the first state, of state after state, and of a symbol in a state."""

    def __init__(self, first: np.ndarray, step: np.ndarray, shown: np.ndarray):
        self.first, self.step, self.shown = (np.log(x / x.sum(axis=-1, keepdims=True)) for x in (first + 0.1, step + 0.1, shown + 0.1))


def train(lines: DataFrame) -> Model:
    """Counts over all labelled lines (conv_id, turn, piece, role, symbol). Rows of other roles are left out.

    Steps within a turn follow from its number of lines; steps between turns come from joining a turn to the next one.
    """
    role = F.array_position(F.array(*map(F.lit, ROLES)), F.col("role")) - 1
    known = lines.where(F.col("role").isin(*ROLES)).withColumn("state", (role * 2 + F.least(F.col("piece"), F.lit(1))).cast("int"))
    shown = np.zeros((STATES, SYMBOLS))
    for r in known.groupBy("state", "symbol").count().collect():
        shown[r["state"], r["symbol"]] = r["count"]
    turns = known.groupBy("conv_id", "turn").agg(F.min(role).cast("int").alias("r"), F.count("*").alias("n"))
    after = turns.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("r").alias("next"))
    first, step = np.zeros(STATES), np.zeros((STATES, STATES))
    joined = turns.join(after, ["conv_id", "turn"], "left")
    pairs = joined.groupBy("r", "next", F.least("n", F.lit(2)).alias("m"))
    for r in pairs.agg(F.sum(F.col("n") - 2).alias("inner"), F.count("*").alias("k")).collect():
        start, inside = r["r"] * 2, r["r"] * 2 + 1
        if r["m"] == 2:
            step[start, inside] += r["k"]
            step[inside, inside] += r["inner"]
        if r["next"] is not None:
            step[inside if r["m"] == 2 else start, r["next"] * 2] += r["k"]
    begins = turns.groupBy("conv_id").agg(F.min("turn").alias("turn"))
    for r in turns.join(begins, ["conv_id", "turn"]).groupBy("r").count().collect():
        first[r["r"] * 2] = r["count"]
    return Model(first, step, shown)


def best_between(model: Model, symbols: np.ndarray, begins: bool) -> np.ndarray:
    """The best score of a block for each state before it and each last state. At the start of a conversation no state is before."""
    entry = np.tile(model.first, (STATES, 1)) if begins else model.step
    score = entry + model.shown[:, symbols[0]]
    for s in symbols[1:]:
        score = (score[:, :, None] + model.step[None]).max(axis=1) + model.shown[:, s]
    return score


def decode(model: Model, symbols: np.ndarray, before: int | None, last: int | None) -> np.ndarray:
    """The best states of a block between the state before it and its last state."""
    score = (model.first if before is None else model.step[before]) + model.shown[:, symbols[0]]
    back = np.zeros((len(symbols), STATES), np.int64)
    for t, s in enumerate(symbols[1:], 1):
        ways = score[:, None] + model.step
        back[t] = ways.argmax(axis=0)
        score = ways.max(axis=0) + model.shown[:, s]
    states = np.zeros(len(symbols), np.int64)
    states[-1] = int(score.argmax()) if last is None else last
    for t in range(len(symbols) - 1, 0, -1):
        states[t - 1] = back[t, states[t]]
    return states


def fold(model: Model, blocks: list[np.ndarray]) -> list[tuple[int, int]]:
    """The state before and the last state of each block of a conversation, from the blocks' matrices in order."""
    score, back = blocks[0][0], []
    for matrix in blocks[1:]:
        ways = score[:, None] + matrix
        back.append(ways.argmax(axis=0))
        score = ways.max(axis=0)
    last = [int(score.argmax())]
    for b in reversed(back):
        last.append(int(b[last[-1]]))
    last.reverse()
    return [(-1, last[0]), *zip(last[:-1], last[1:], strict=True)]


def _decoded(lines: DataFrame, model: Model) -> DataFrame:
    """(part, block, conv_id, states): blocks of lines with their decoded states."""
    kind = lines.schema["conv_id"].dataType.simpleString()
    sent = lines.sparkSession.sparkContext.broadcast(model)
    per_part = lines.withColumn("block", F.floor(F.col("place") / BLOCK_LINES).cast("int")).groupBy("conv_id", "part", "block").agg(
        F.array_sort(F.collect_list(F.struct("place", "symbol"))).alias("rows"))
    blocks = per_part.select("conv_id", "part", "block", F.col("rows.symbol").alias("symbols"))
    first = blocks.groupBy(F.col("conv_id").alias("c")).agg(F.min(F.struct("part", "block")).alias("start"))
    begun = stored(blocks.join(first, F.col("conv_id").eqNullSafe(F.col("c"))).select(
        "conv_id", "part", "block", "symbols", (F.struct("part", "block") == F.col("start")).alias("begins")), "blocks")

    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [best_between(sent.value, np.array(s), b).tobytes() for s, b in zip(
                batch.column("symbols").to_pylist(), batch.column("begins").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*map(batch.column, BLOCK_KEY), pa.array(out, pa.binary())], [*BLOCK_KEY, "m"])

    def borders(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["part", "block"])
        found = fold(sent.value, [np.frombuffer(m, np.float64).reshape(STATES, STATES) for m in frame["m"]])
        return pd.DataFrame({
            "part": frame["part"].to_numpy(), "block": frame["block"].to_numpy(), "own": frame["conv_id"].to_numpy(),
            "before": [f[0] for f in found], "last": [f[1] for f in found]})

    # A conversation of one block needs no fold. Of a longer one, a few numbers for 2,048 lines come together.
    many = begun.groupBy("conv_id").agg(F.count("*").alias("k")).where("k > 1").select(F.col("conv_id").alias("c"))
    chained = begun.join(many, F.col("conv_id").eqNullSafe(F.col("c")), "left_semi").mapInArrow(
        matrices, f"conv_id {kind}, part int, block int, m binary")
    ends = chained.groupBy("conv_id").applyInPandas(borders, f"part int, block int, own {kind}, before int, last int")
    same = F.col("conv_id").eqNullSafe(F.col("own")) & (F.col("part") == F.col("p")) & (F.col("block") == F.col("b"))
    placed = begun.join(ends.withColumnsRenamed({"part": "p", "block": "b"}), same, "left").select(
        *BLOCK_KEY, "symbols", *[F.coalesce(c, F.lit(-1)).alias(c) for c in ("before", "last")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = (batch.column(k).to_pylist() for k in ("symbols", "before", "last"))
            out = [decode(sent.value, np.array(s), None if b < 0 else b, None if e < 0 else e).tolist()
                   for s, b, e in zip(*columns, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*map(batch.column, BLOCK_KEY), pa.array(out, pa.list_(pa.int32()))], [*BLOCK_KEY, "states"])

    return placed.mapInArrow(run, f"conv_id {kind}, part int, block int, states array<int>")


def recover_turns(lines: DataFrame, model: Model) -> DataFrame:
    """(conv_id, turn_index, role, text, rendered) from lines that `with_symbols` has stored.

    A turn begins where the decoded state says so, and at the first line of a conversation. Its text is its lines without the marker and
    without blank lines at its ends; `rendered` is the canonical form. Turns are numbered from 0 over all partitions.
    A null conv_id is a conversation like any other; an empty table gives no rows.
    """
    states = _decoded(lines, model).select(F.col("conv_id").alias("c"), F.col("part").alias("p"), F.col("block").alias("b"), "states")
    blocked = lines.withColumn("block", F.floor(F.col("place") / BLOCK_LINES).cast("int"))
    base = blocked.groupBy("conv_id", "part", "block").agg(F.min("place").alias("low"))
    same_block = F.col("c").eqNullSafe(F.col("conv_id")) & (F.col("p") == F.col("part")) & (F.col("b") == F.col("block"))
    known = states.join(base, same_block).select("c", "p", F.posexplode("states").alias("i", "state"), "low").select(
        "c", "p", (F.col("low") + F.col("i")).alias("at"), "state")
    same_line = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("part") == F.col("p")) & (F.col("place") == F.col("at"))
    labelled = stored(lines.join(known, same_line).select("conv_id", "part", "place", "line", "state"), "labelled")
    starts = labelled.groupBy("conv_id", "part").agg(F.sum((F.col("state") % 2 == 0).cast("long")).alias("n"))
    # One row for each conversation and partition that holds a stretch of it.
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = starts.select(
        F.col("conv_id").alias("c"), F.col("part").alias("p"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    within = Window.partitionBy("conv_id", "part").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    numbered = labelled.withColumn("k", F.sum((F.col("state") % 2 == 0).cast("long")).over(within)).join(
        offsets, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("part") == F.col("p"))).withColumn(
        "turn_index", F.greatest(F.col("earlier") + F.col("k") - 1, F.lit(0)))
    kind = lines.schema["conv_id"].dataType.simpleString()
    turns = numbered.groupBy("conv_id", "turn_index").agg(F.array_sort(F.collect_list(F.struct("part", "place", "line", "state"))).alias("rows"))

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            roles, texts = [], []
            for own, states_ in zip(batch.column("own").to_pylist(), batch.column("states").to_pylist(), strict=True):
                roles.append(ROLES[states_[0] // 2])
                begin = marker(own[0])[1] if own else 0
                texts.append("\n".join([own[0][begin:], *own[1:]]).strip("\n"))
            shown = [f"<|im_start|>{r}\n{t}<|im_end|>" for r, t in zip(roles, texts, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), batch.column("turn_index"), *(pa.array(x, pa.string()) for x in (roles, texts, shown))],
                ["conv_id", "turn_index", "role", "text", "rendered"])

    flat = turns.select("conv_id", "turn_index", F.col("rows.line").alias("own"), F.col("rows.state").alias("states"))
    return flat.mapInArrow(
        render, f"conv_id {kind}, turn_index long, role string, text string, rendered string")


def fitting_fold(conv_id: Column) -> Column:
    """Conversations whose roles the model is fitted to; the others are held out."""
    return F.pmod(F.xxhash64(F.lit(3), conv_id), F.lit(2)) == 0


def canonical_turns(conversations: DataFrame) -> DataFrame:
    """Writes the conversations as transcripts, forgets the roles, and recovers them with a model fitted to half of the conversations."""
    lines = with_symbols(as_transcript(conversations), ["turn", "role", "piece"], ["role"])
    model = train(lines.where(fitting_fold(F.col("conv_id"))))
    return recover_turns(lines.drop("role", "turn", "piece"), model)
