"""A prefix trie of conversations, by union-find over the common prefixes of sorted neighbours.

1. Turns are numbered within their conversation over sorted range partitions; no task needs a whole conversation for that.
2. A conversation becomes a key of 16 bytes a turn. Distinct keys are sorted over the cluster; a conversation that starts with another one
   follows it. The longest common prefix (LCP) of two neighbours is an edge with that depth.
3. In each partition a union-find takes the edges in descending depth; a merge at depth d makes the branching node of that depth, or
   lets a tree join one that ends there already. What touches a border of the partition can still grow: it and its neighbours are kept as
   a contracted forest, at most two trees for each depth, with the edges between them. All other nodes are final.
4. Contracted forests of neighbouring partitions are merged in the same way, some at a time, until one is left.
5. Nodes between a branching node and the next one above it have the same members; they are written out from the depths and word counts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plyforge.sources.paths import stored

TURN = 16
SHARED, FAMILY = 4, 20
KEYS_PER_PART = 65_536
FAN = 32
#: Range bounds go to the driver, so they look at the first turns of a key only.
BOUND_TURNS = 16


class Turns(NamedTuple):
    """Numbered turns (conv_id, pos from 1, digest, words) and conversations (conv_id, len)."""

    turns: DataFrame
    conversations: DataFrame


def numbered_turns(conversations: DataFrame) -> Turns:
    """The turns of every conversation in order, null turns first; rows of equal turn are ordered by a digest of role and text."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.substring(F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)), 1, TURN)
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", digest.alias("digest"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"))
    order = ["conv_id", "turn", "digest"]
    # Equal rows travel as one.
    once = stored(rows.groupBy(*order).agg(F.max("words").alias("words"), F.count("*").alias("n")), "turns")

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, conv, count = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            own, n = (batch.column(c).to_numpy() for c in ("conv_id", "n"))
            if not len(own):
                continue
            before = np.cumsum(n) - n
            starts = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
            base = np.repeat(before[starts], np.diff(np.append(starts, len(own))))
            place = before - base
            if own[0] == conv:
                place[own == conv] += count
            conv, count = own[-1], int(place[-1] + n[-1])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("conv_id", "digest", "words", "n")), pa.array(place), pa.array(np.full(len(own), part, np.int32))],
                ["conv_id", "digest", "words", "n", "place", "part"])

    placed = stored(once.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        number, "conv_id long, digest binary, words long, n long, place long, part int"), "places")
    # A row for each partition that holds a stretch of the conversation.
    pieces = stored(placed.groupBy("conv_id", "part").agg(F.sum("n").alias("n")), "pieces")
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    later = pieces.withColumn("offset", F.sum("n").over(earlier)).where("offset is not null").select(
        F.col("conv_id").alias("c"), F.col("part").alias("p"), "offset")
    start = F.coalesce("offset", F.lit(0)) + F.col("place") + 1
    turns = placed.join(later, (F.col("conv_id") == F.col("c")) & (F.col("part") == F.col("p")), "left").select(
        "conv_id", F.explode(F.sequence(start, start + F.col("n") - 1)).alias("pos"), "digest", "words")
    return Turns(turns, pieces.groupBy("conv_id").agg(F.sum("n").alias("len")))


class Rebuilt(NamedTuple):
    """Turns (conv_id, d from 1, digest, words), and conversations (conv_id, len, keep): a key needs the first `keep` turns."""

    turns: DataFrame
    conversations: DataFrame


def rebuilt_conversations(conversations: DataFrame) -> Rebuilt:
    """Conversations that begin with the first turns of the head of their family of `FAMILY`; how many follows from a hash of the id.

    No two conversations share more than the shorter one has. So the longest conversation among those that begin with the same turn needs no more
    of its turns in its key than the second longest has, and one more: a single giant conversation never becomes one value.
    """
    turns, found = numbered_turns(conversations)
    turns = stored(turns, "numbered")
    first = turns.where(F.col("pos") <= SHARED).groupBy(F.col("conv_id").alias("h")).agg(
        F.array_sort(F.collect_list(F.struct("pos", "digest", "words"))).alias("head"))
    taken = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % SHARED).cast("int")
    own = found.join(first, found["conv_id"] == first["h"]).select("conv_id", "len", F.col("head").alias("own"), taken.alias("h"))
    family = own.withColumn("base", F.col("conv_id") - F.col("conv_id") % FAMILY)
    heads = first.select(F.col("h").alias("b"), "head")
    joined = family.join(heads, family["base"] == heads["b"], "left").select(
        "conv_id", "h", "own", "len", F.coalesce(F.slice("head", F.lit(1), F.col("h")), F.slice("own", 1, 0)).alias("head"))
    length = F.size("head") + F.greatest(F.col("len") - F.col("h"), F.lit(0))
    opening = F.when(F.size("head") > 0, F.get("head", F.lit(0))["digest"]).otherwise(F.get("own", F.col("h"))["digest"])
    plan = stored(joined.select("conv_id", "h", "head", length.cast("long").alias("len"), opening.alias("opening")), "plan")
    longest = plan.where("len > 0").groupBy("opening").agg(F.max(F.struct("len", "conv_id")).alias("top")).select("opening", "top.*")
    longest = stored(longest.withColumnsRenamed({"opening": "o", "conv_id": "c"}), "longest")
    second = plan.join(longest, F.col("conv_id") == F.col("c"), "left_anti").groupBy("opening").agg(F.max("len").alias("most"))
    cuts = longest.join(second, F.col("o") == F.col("opening"), "left").withColumn("cut", F.coalesce("most", F.lit(0)) + 1).where(
        "cut < len").select("c", "cut")
    kept = stored(plan.join(cuts, plan["conv_id"] == cuts["c"], "left").select(
        "conv_id", "h", "head", "len", F.coalesce("cut", "len").alias("keep")), "kept")
    shift = kept.select(F.col("conv_id").alias("c"), "h", F.size("head").alias("k"))
    rest = turns.join(shift, turns["conv_id"] == shift["c"]).where("pos > h").select(
        "conv_id", (F.col("pos") - F.col("h") + F.col("k")).alias("d"), "digest", "words")
    begun = kept.select("conv_id", F.explode("head").alias("t")).select("conv_id", F.col("t.pos").alias("d"), "t.digest", "t.words")
    return Rebuilt(rest.unionByName(begun), kept.select("conv_id", "len", "keep"))


def prefix_id(key: bytes, depth: int) -> bytes:
    """What names a node, wherever it is found."""
    return hashlib.blake2b(key[:TURN * depth], digest_size=16, salt=depth.to_bytes(8, "little")).digest()


def conversation_keys(rebuilt: Rebuilt) -> DataFrame:
    """(conv_id, key, id, cum, whole) of every conversation: its turns' digests, the name of its last node, its running word counts from 0.

    `whole` is false where the key stops short of the conversation.
    """
    whole = rebuilt.conversations.select(F.col("conv_id").alias("c"), "keep", (F.col("keep") == F.col("len")).alias("whole"))
    used = rebuilt.turns.join(whole, F.col("conv_id") == F.col("c")).where("d <= keep").groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("d", "digest", "words"))).alias("t"))
    rows = whole.join(used, F.col("c") == F.col("conv_id"), "left").select(F.col("c").alias("conv_id"), "whole", "t.digest", "t.words")

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, cums = [], []
            for digests, words in zip(batch.column("digest").to_pylist(), batch.column("words").to_pylist(), strict=True):
                keys.append(b"".join(digests or ()))
                cums.append(np.concatenate([[0], np.cumsum(np.array(words or [], np.int64))]))
            ids = [prefix_id(k, len(k) // TURN) for k in keys]
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), pa.array(keys, pa.binary()), pa.array(ids, pa.binary()), pa.array(cums, pa.list_(pa.int64())),
                 batch.column("whole")], ["conv_id", "key", "id", "cum", "whole"])

    return rows.mapInArrow(make, "conv_id long, key binary, id binary, cum array<long>, whole boolean")


class Tree:
    """The top node of a tree: its name and depth, members, smallest member, children, leaves below, saved tokens below, words up to it."""

    __slots__ = ("id", "depth", "n", "low", "kids", "below", "saved", "words")

    def __init__(self, id_: bytes, depth: int, n: int, low: int | None, kids: int, below: int, saved: int, words: int):
        self.id, self.depth, self.n, self.low, self.kids, self.below, self.saved, self.words = id_, depth, n, low, kids, below, saved, words

    def row(self) -> tuple:
        return self.id, self.depth, self.n, self.low, self.kids, self.below, self.saved, self.words


class Edge(NamedTuple):
    """The longest common prefix of two neighbours: its depth, its words and its name."""

    depth: int
    words: int
    id: bytes


def merged(trees: list[Tree], edge: Edge, closed: list[tuple]) -> Tree:
    """The tree whose top is the edge's prefix, over neighbouring trees; tops that are that node already become one with it."""
    top = Tree(edge.id, edge.depth, 0, None, 0, 0, 0, edge.words)
    for t in trees:
        top.n += t.n
        top.low = t.low if top.low is None else min(top.low, t.low)
        if t.depth == edge.depth:
            top.kids, top.below, top.saved = top.kids + t.kids, top.below + t.below, top.saved + t.saved
        else:
            leaves = t.below if t.kids else 1
            top.kids, top.below = top.kids + 1, top.below + leaves
            top.saved += (t.n - 1) * (t.words - edge.words) + t.saved
            closed.append((*t.row(), edge.depth, edge.id))
    return top


def contract(trees: list[Tree], edges: list[Edge], closed: list[tuple], open_: bool) -> tuple[list[Tree], list[Edge]]:
    """Merges neighbouring trees along their edges, deepest first, by union-find; final nodes go to `closed`.

    If `open_`, the first and the last tree may have neighbours that are not known yet. They are set aside, and so is every tree that an edge
    ties to one set aside; along such edges nothing is merged. Trees between them that meet at one depth still become one partial node.
    Returns what is left: the contracted forest.
    """
    parent = list(range(len(trees)))
    aside = [open_ and i in (0, len(trees) - 1) for i in range(len(trees))]
    left: set[int] = set()

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = i = parent[parent[i]]
        return i

    def join(chain: list[int], own: list[int]) -> None:
        """One chain of neighbouring trees, tied by edges of one depth."""
        first, last = aside[chain[0]], aside[chain[-1]]
        inner = chain[first:len(chain) - last]
        left.update(own[:1] if first else [], own[-1:] if last else [])
        if not inner:
            return
        if len(inner) > 1:
            for c in inner[1:]:
                parent[c] = inner[0]
            trees[inner[0]] = merged([trees[c] for c in inner], edges[own[0]], closed)
        aside[inner[0]] = first or last

    order = sorted(range(len(edges)), key=lambda i: (-edges[i].depth, i))
    at = 0
    while at < len(order):
        chain, own = [find(order[at])], []
        while True:
            i = order[at]
            chain.append(find(i + 1))
            own.append(i)
            at += 1
            if at == len(order) or edges[order[at]].depth != edges[i].depth or find(order[at]) != chain[-1]:
                break
        join(chain, own)
    rest = [trees[i] for i in range(len(trees)) if parent[i] == i]
    return rest, [edges[i] for i in sorted(left)]


def _common(a: bytes, b: bytes) -> int:
    """Turns that two keys have in common at their start."""
    size = min(len(a), len(b)) // TURN
    same = np.frombuffer(a, np.uint64, 2 * size) == np.frombuffer(b, np.uint64, 2 * size)
    return size if same.all() else int(np.argmin(same)) // 2


def _edge(a: bytes, b: bytes, cum: list[int]) -> Edge:
    depth = _common(a, b)
    return Edge(depth, cum[depth], prefix_id(a, depth))


TREE = "id binary, depth long, n long, low long, kids long, below long, saved long, words long"
#: `part` is null for final nodes, which have the depth and the name of the node above; the rest are trees of a contracted forest in order.
FOREST = TREE + ", up_depth long, up_id binary, part int, place int, edge_words long, first binary, last binary, cum array<long>"
_KINDS = [pa.binary(), *[pa.int64()] * 8, pa.binary(), pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int64())]
_NAMES = [f.split()[0] for f in FOREST.split(", ")]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(_NAMES)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _KINDS, strict=True)], _NAMES)


def _forest_rows(trees: list[Tree], edges: list[Edge], closed: list[tuple], part: int, first: bytes, last: bytes, cum: list[int]) -> pa.RecordBatch:
    """Final nodes, and the trees left, each with the edge to the next; the last tree has the forest's first and last key."""
    rows = [(*c, *[None] * 6) for c in closed]
    for i, (t, e) in enumerate(zip(trees, [*edges, None], strict=True)):
        ends = (None, None, None) if e else (first, last, cum)
        rows.append((*t.row(), e and e.depth, e and e.id, part, i, e and e.words, *ends))
    return _batch(rows)


def _partition_forests(keys: DataFrame, parts: int) -> DataFrame:
    """Distinct keys (key, id, n, low, cum, whole), sorted, to the forests of the partitions."""
    bound = F.substring("key", 1, TURN * BOUND_TURNS)
    ranged = keys.repartitionByRange(parts, bound).sortWithinPartitions("key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees: list[Tree] = []
        edges: list[Edge] = []
        first = last = None
        ends: list[int] = []
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("key", "id", "n", "low", "cum", "whole"))
            for key, id_, n, low, cum, whole in zip(*columns, strict=True):
                if last is None:
                    first = key
                else:
                    edges.append(_edge(last, key, cum))
                # A key that stops short has one child, which has one leaf.
                trees.append(Tree(id_, len(key) // TURN, n, low, int(not whole), int(not whole), 0, cum[-1]))
                last, ends = key, cum
        if trees:
            closed: list[tuple] = []
            rest, left = contract(trees, edges, closed, open_=True)
            yield _forest_rows(rest, left, closed, TaskContext.get().partitionId(), first, last, ends)

    return stored(ranged.mapInArrow(run, FOREST), "forests")


def _merge_forests(forests: DataFrame, final: bool) -> DataFrame:
    """Forests of `FAN` neighbouring partitions become one; the final one has no open ends and gets the root."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, trees, edges = None, [], []
        first = last = None
        ends: list[int] = []

        def done() -> pa.RecordBatch:
            closed: list[tuple] = []
            rest, left = contract(trees, edges, closed, open_=not final)
            if not final:
                return _forest_rows(rest, left, closed, group, first, last, ends)
            root = merged(rest, Edge(0, 0, prefix_id(b"", 0)), closed)
            return _batch([(*c, *[None] * 6) for c in [*closed, (*root.row(), None, None)]])

        for batch in batches:
            for row in zip(*(batch.column(n).to_pylist() for n in ["group", *_NAMES]), strict=True):
                own, tree = row[0], Tree(*row[1:9])
                up_depth, up_id, _, place, words, first_, last_, cum = row[9:]
                if own != group:
                    if group is not None:
                        yield done()
                    group, trees, edges, first, last = own, [], [], None, None
                trees.append(tree)
                if up_id is not None:
                    edges.append(Edge(up_depth, words, up_id))
                else:
                    # The forest's keys come with its last tree: the edge to the forest before is put in front of its first tree.
                    if last is None:
                        first = first_
                    else:
                        edges.insert(len(edges) - place, _edge(last, first_, ends))
                    last, ends = last_, cum
        if group is not None:
            yield done()

    rows = forests.withColumn("group", F.floor(F.col("part") / FAN).cast("int"))
    return stored(rows.repartition("group").sortWithinPartitions("group", "part", "place").mapInArrow(run, FOREST), "forests")


class Trie(NamedTuple):
    """Nodes at which the trie branches or a conversation ends, and the node of each conversation's end (id, conv_id).

    A node stands for itself and for the nodes above it, down from `up_depth`, that have the same members.
    """

    nodes: DataFrame
    ends: DataFrame


def prefix_trie(keys: DataFrame) -> Trie:
    """The trie over keys (conv_id, key, id, cum, whole; a stored table)."""
    once = stored(keys.groupBy("key").agg(
        F.first("id").alias("id"), F.count("*").alias("n"), F.min("conv_id").alias("low"), F.first("cum").alias("cum"),
        F.min("whole").alias("whole")), "keys")
    parts = max(1, -(-once.count() // KEYS_PER_PART))
    rounds = [_partition_forests(once, parts)]
    while True:
        most = rounds[-1].agg(F.max("part")).first()[0]
        if most is None:
            break
        rounds.append(_merge_forests(rounds[-1].where("part is not null"), final=most < FAN))
    nodes = rounds[0]
    for r in rounds[1:]:
        nodes = nodes.unionByName(r)
    columns = ["id", "depth", "n", "low", "kids", F.when(F.col("kids") > 0, F.col("below")).otherwise(1).alias("leaves"), "saved", "up_depth", "up_id"]
    return Trie(stored(nodes.where("part is null").select(*columns), "nodes"), keys.where("whole").select("id", "conv_id"))


def end_digests(ends: DataFrame) -> DataFrame:
    """(id, sha): the hash of the ids that end at a node, ascending and joined by commas. A hash needs them one after the other; they are streamed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest = None, None
        for batch in batches:
            out = []
            for id_, conv in zip(batch.column("id").to_pylist(), batch.column("conv_id").to_pylist(), strict=True):
                if id_ != now:
                    if now is not None:
                        out.append((now, digest.hexdigest()))
                    now, digest = id_, hashlib.sha256(str(conv).encode())
                else:
                    digest.update(f",{conv}".encode())
            yield pa.RecordBatch.from_arrays(
                [pa.array([o[0] for o in out], pa.binary()), pa.array([o[1] for o in out], pa.string())], ["id", "sha"])
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now], pa.binary()), pa.array([digest.hexdigest()])], ["id", "sha"])

    return ends.repartition("id").sortWithinPartitions("id", "conv_id").mapInArrow(run, "id binary, sha string")


NOTHING = hashlib.sha256().hexdigest()
RESULT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def trie_nodes(conversations: DataFrame) -> DataFrame:
    """What op13 returns: one row for each node of the trie of the rebuilt conversations.

    A null role or text counts as empty; a null turn comes first; rows of equal turn are ordered by a digest; repeated rows are turns of their
    own. Rows without conv_id are left out, as nothing can be rebuilt for them. A conversation may end up without turns and then ends at the root.
    An empty table has no nodes, not even the root; other columns are not looked at.
    """
    rebuilt = rebuilt_conversations(conversations)
    rebuilt = Rebuilt(stored(rebuilt.turns, "rebuilt"), rebuilt.conversations)
    keys = stored(conversation_keys(rebuilt), "conversations")
    nodes, ends = prefix_trie(keys)
    above = nodes.select(F.col("id").alias("p"), F.col("low").alias("up"))
    shas = end_digests(ends).withColumnRenamed("id", "e")
    member = keys.select(F.col("conv_id").alias("m"), "cum")
    full = nodes.join(above, nodes["up_id"] == above["p"], "left").join(shas, nodes["id"] == shas["e"], "left")
    # Of the nodes with one member no words are needed.
    shared = full.join(member, (F.col("low") == F.col("m")) & (F.col("n") > 1), "left")
    high = F.coalesce(F.col("up_depth"), F.lit(-1))
    words_above: Column = F.when(F.col("n") > 1, F.slice("cum", F.greatest(high, F.lit(0)).cast("int") + 1, F.greatest(
        F.col("depth") - high, F.lit(1)).cast("int"))).otherwise(F.array_repeat(F.lit(0).cast("long"), (F.col("depth") - high).cast("int")))
    words = F.when(F.col("n") > 1, F.element_at("cum", F.col("depth").cast("int") + 1)).otherwise(0)
    each = shared.select("low", "depth", "n", "kids", "leaves", "saved", "up", "up_depth", "sha", words.alias("words"),
                         F.posexplode(words_above).alias("i", "before"))
    d = F.when(F.col("up_depth").isNull(), 0).otherwise(F.col("up_depth") + F.col("i") + 1)
    last = d == F.col("depth")
    saved = F.when(F.col("up_depth").isNull(), F.col("saved")).otherwise((F.col("n") - 1) * (F.col("words") - F.col("before")) + F.col("saved"))
    listed = each.select(
        F.col("low").alias("conv_id"), d.cast("long").alias("depth"),
        F.when(F.col("up_depth").isNull(), None).when(F.col("i") == 0, F.col("up")).otherwise(F.col("low")).alias("parent_conv_id"),
        F.col("n").alias("n_convs"), F.when(last, F.col("kids")).otherwise(1).cast("long").alias("n_children"), F.col("leaves").cast("long").alias("n_leaves"),
        saved.alias("saved_tokens"), F.when(last, F.coalesce("sha", F.lit(NOTHING))).otherwise(NOTHING).alias("ends_sha256"))
    # Turns beyond a key that stops short belong to one conversation alone.
    alone = rebuilt.conversations.where("keep < len").select(F.col("conv_id").alias("c"), "len", "keep")
    one = F.lit(1).cast("long")
    tail = rebuilt.turns.select("conv_id", "d").join(alone, F.col("conv_id") == F.col("c")).where("d > keep").select(
        "conv_id", F.col("d").cast("long").alias("depth"), F.col("conv_id").alias("parent_conv_id"), one.alias("n_convs"),
        (F.col("d") < F.col("len")).cast("long").alias("n_children"), one.alias("n_leaves"), F.lit(0).cast("long").alias("saved_tokens"),
        F.when(F.col("d") == F.col("len"), F.sha2(F.col("conv_id").cast("string"), 256)).otherwise(NOTHING).alias("ends_sha256"))
    return listed.unionByName(tail).select(*RESULT)
