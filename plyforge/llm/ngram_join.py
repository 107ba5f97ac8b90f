"""Documents whose sets of word n-grams have a Jaccard similarity at or above a threshold, as connected components.

1. Documents with the same set form a class, found by a 128-bit hash of the set. Only one set per class goes on.
2. n-grams are put into one order for all sets: those that few classes have first. A set's first n - ceil(t n) + 1
   n-grams are its short inverted lists; two similar sets share one of them. Only the n-grams whose hashes lie below a fixed cut are
   counted and ordered by count, the others follow in order of their hash, and the heaviest n-grams that such prefixes hold
   come last of all wherever their hashes lie: any order that all sets share is right.
3. In each inverted list every class is compared with one centre. This joins near copies, however many, without comparing them with each other.
4. Lists in which more than one component is left are searched in full, in blocks of classes, by T-occurrence: the lists of the
   query's n-grams are merged but for the longest ones, which are probed by bisection (DivideSkip), and the overlap decides.
   Pairs that are connected already are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from plyforge.llm.components import components
from plyforge.llm.texts import breaks_at_space, mix, words
from plyforge.sources.paths import stored

SHINGLE, PERCENT = 3, 90
BLOCK = 512
HEAD = 16
#: An n-gram is heavy if more prefixes hold it than two blocks have room for. The heaviest of them, half a megabyte of hashes, are put last.
HEAVY, MOST_HEAVY, ROUNDS = 2 * BLOCK, 1 << 16, 2
PROBES = 8
MU = 0.01


def shingle_sets(column: pa.Array, size: int = SHINGLE) -> Iterator[np.ndarray]:
    """The sorted distinct n-gram hashes of each text. A text of fewer words is one n-gram, one without words has none."""
    for group in words(column, breaks_at_space()):
        text, hashes = group.text - group.first, group.hash
        count = group.last - group.first
        edges = np.searchsorted(text, np.arange(count + 1))
        run = np.full(max(0, len(hashes) - size + 1), size, np.uint64)
        for k in range(size):
            run = mix(run + hashes[k:k + len(run)])
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            if b - a >= size:
                yield np.unique(run[a:b - size + 1])
            elif b > a:
                whole = np.array([b - a], np.uint64)
                for h in hashes[a:b]:
                    whole = mix(whole + h)
                yield whole
            else:
                yield np.zeros(0, np.uint64)


def least_overlap(n: int, percent: int = PERCENT) -> int:
    """The least overlap of a set of n with any set that is similar to it."""
    return -(-percent * n // 100)


def cut_of(percent: int = PERCENT) -> int:
    """Hashes below it are ordered by count: a seventh of their range at 90 percent, where a similar pair needs a tenth of a set.

    It grows with the part that a pair needs, up to half the range, so that the prefix of nearly every set lies below it.
    """
    return min((1 << 64) * (100 - percent) // 70, (1 << 63) - 1)


def _signed(values: np.ndarray) -> np.ndarray:
    return values.astype(np.uint64).view(np.int64)


def _prints(own: np.ndarray) -> tuple[int, int]:
    """Two hashes of a set."""
    mixed = mix(own + np.uint64(77))
    one, two = np.bitwise_xor.reduce(mixed, initial=0, keepdims=True), np.add.reduce(mixed * np.uint64(0x2545F4914F6CDD1D), keepdims=True)
    return int(_signed(one)[0]), int(_signed(two)[0])


def _among(values: np.ndarray, heavy: np.ndarray) -> np.ndarray:
    """Which of the values are in the sorted array."""
    if not len(heavy):
        return np.zeros(len(values), bool)
    return heavy[np.minimum(np.searchsorted(heavy, values), len(heavy) - 1)] == values


def _set_rows(docs: DataFrame, size: int, percent: int, heavy: np.ndarray | None = None) -> DataFrame:
    """doc_id, n, two hashes of the set, its low n-grams, how many more of these there are than the prefix needs, and how many lie below the cut.

    Given heavy n-grams, only the rows that would have fewer light ones in `low` than the prefix needs: `low` is then that prefix, light n-grams
    first, and `below` counts light ones. Each row's own text tells, so no text moves to find these.
    """
    kind, cut = docs.schema["doc_id"].dataType.simpleString(), np.uint64(cut_of(percent))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, n, one, two, spare, below, low = [], [], [], [], [], [], []
            for i, own in enumerate(shingle_sets(batch.column("text"), size)):
                prefix = len(own) - least_overlap(len(own), percent) + 1 if len(own) else 0
                under = int(np.searchsorted(own, cut))
                taken = max(under, prefix)
                chosen = own[:taken]
                if heavy is not None:
                    light = ~_among(_signed(chosen), heavy)
                    if light.sum() >= prefix:
                        continue
                    chosen, taken, under = _light_first(own, heavy, prefix), prefix, int(light[:under].sum())
                at.append(i)
                n.append(len(own))
                prints = _prints(own)
                one.append(prints[0])
                two.append(prints[1])
                below.append(under)
                spare.append(taken - prefix)
                low.append(chosen)
            ends = np.concatenate([[0], np.cumsum([len(x) for x in low])]).astype(np.int32)
            flat = _signed(np.concatenate([np.zeros(0, np.uint64), *low]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(at, pa.int64())), pa.array(n, pa.int64()), pa.array(one, pa.int64()), pa.array(two, pa.int64()),
                 pa.array(spare, pa.int32()), pa.array(below, pa.int32()), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))],
                ["doc_id", "n", "one", "two", "spare", "below", "low"])

    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(rows, f"doc_id {kind}, n long, one long, two long, spare int, below int, low array<long>")


def _entries(classes: DataFrame) -> DataFrame:
    return classes.select("c", F.explode("low").alias("h"))


def _shared(classes: DataFrame) -> DataFrame:
    """(h, df) of the n-grams that more than one class has in `low`."""
    return stored(_entries(classes).groupBy("h").agg(F.count("*").alias("df")).where("df > 1"), "counts")


def _heaviest(counts: DataFrame, known: np.ndarray) -> np.ndarray:
    """The known heavy n-grams and the heaviest new ones, sorted, `MOST_HEAVY` in all."""
    found = counts.where(F.col("df") > HEAVY).orderBy(F.desc("df"), "h").limit(MOST_HEAVY).select("h").toArrow()["h"].to_numpy()
    fresh = found[~np.isin(found, known)][:MOST_HEAVY - len(known)]
    return np.sort(np.concatenate([known, fresh]))


def _light_first(own: np.ndarray, heavy: np.ndarray, prefix: int) -> np.ndarray:
    """The prefix of a set: light n-grams by hash, then heavy ones."""
    last = _among(_signed(own), heavy)
    behind = np.sort(_signed(own[last])).view(np.uint64)
    return np.concatenate([own[~last], behind])[:prefix]


def _without_heavy(classes: DataFrame, heavy: np.ndarray) -> DataFrame:
    """The classes without heavy n-grams; where light ones do not fill the prefix, `spare` is negative."""
    names = ["c", "least_id", "one", "two", "n", "spare", "below", "low"]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            low = batch.column("low")
            grams = low.flatten().to_numpy()
            there = _among(grams, heavy)
            kept = np.concatenate([[0], np.cumsum(~there)])
            ends = np.concatenate([[0], np.cumsum(low.value_lengths().to_numpy())])
            held = pa.array((np.diff(ends) - np.diff(kept[ends])).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in names[:5]), pc.subtract(batch.column("spare"), held), pc.subtract(batch.column("below"), held),
                 pa.ListArray.from_arrays(pa.array(kept[ends].astype(np.int32)), pa.array(grams[~there]))], names)

    return classes.select(*names).mapInArrow(rows, classes.select(*names).schema)


def _heavy_table(spark: SparkSession, heavy: np.ndarray) -> DataFrame:
    """Half a megabyte at most, see `MOST_HEAVY`."""
    return spark.createDataFrame(pa.table({"h": pa.array(heavy, pa.int64())}))


def heavy_last(docs: DataFrame, classes: DataFrame, size: int, percent: int) -> tuple[DataFrame, DataFrame, np.ndarray]:
    """The classes with prefixes in which heavy n-grams come last, the counts of these prefixes, and the heavy n-grams.

    A class needs other n-grams than it has taken if it would be left with fewer light ones than its prefix has; its text gives them. These may be
    heavy in turn, hence the rounds. Where the heavy n-grams end decides the length of the lists alone: any set of them is right.
    """
    whole, heavy = classes, np.zeros(0, np.int64)
    first = counts = _shared(classes)
    below = (F.col("h") >= 0) & (F.col("h") < cut_of(percent))
    for _ in range(ROUNDS):
        more = _heaviest(counts, heavy)
        if len(more) == len(heavy):
            break
        heavy = more
        light = _without_heavy(classes, heavy)
        filled = _set_rows(docs, size, percent, heavy).groupBy("one", "two", "n").agg(
            F.first("spare").alias("spare"), F.first("below").alias("below"), F.first("low").alias("low"))
        refilled = stored(light.where("spare < 0").select("c", "one", "two", "n").join(filled, ["one", "two", "n"]).select(
            "c", "n", "spare", "below", "low"), "refilled")
        whole = light.where("spare >= 0").select(*refilled.columns).unionByName(refilled)
        # Every class still has its light n-grams below the cut, so their counts stand; only the other n-grams are counted again.
        last = F.broadcast(_heavy_table(classes.sparkSession, heavy))
        moved = _entries(whole).where(~below).unionByName(_entries(refilled).where(below).join(last, "h", "left_semi"))
        moved = moved.groupBy("h").agg(F.count("*").alias("df")).where("df > 1")
        counts = stored(first.where(below).join(last, "h", "left_anti").unionByName(moved), "counts")
    return whole, counts, heavy


def short_lists(
    classes: DataFrame, percent: int = PERCENT, counts: DataFrame | None = None, heavy: np.ndarray = np.zeros(0, np.int64),
) -> DataFrame:
    """(c, n, alone, listed) for the classes whose prefix has n-grams that other classes have too: these, in order.

    `alone` is the number of light n-grams below the cut that no other class has: they stand in front of the listed ones. An n-gram of one
    class alone needs no list, so most sets keep no list at all. Above the cut an n-gram that one class alone has taken may stand in
    others behind what they took, so it is not counted.
    """
    cut = cut_of(percent)
    counts = _shared(classes) if counts is None else counts
    marked = counts.join(F.broadcast(_heavy_table(classes.sparkSession, heavy).withColumn("heavy", F.lit(True))), "h", "left")
    below = (F.col("h") >= 0) & (F.col("h") < cut)
    # Hashes are signed here: those from 2^63 on are negative and come last.
    place = F.when(F.col("heavy"), 2 ** 62 + 2).when(below, F.col("df")).when(F.col("h") >= 0, 2 ** 62).otherwise(2 ** 62 + 1)
    shared = _entries(classes).join(marked, "h").select("c", F.struct(place.alias("df"), "h").alias("e"))
    # As many as a document has words, at most.
    per_class = shared.groupBy("c").agg(F.array_sort(F.collect_list("e")).alias("es")).join(
        classes.select("c", "n", "spare", "below"), "c")
    prefix = F.slice("es", 1, F.greatest(F.size("es") - F.col("spare"), F.lit(0)))
    alone = F.col("below") - F.size(F.filter("es", lambda e: e["df"] < 2 ** 62))
    return per_class.select("c", "n", alone.cast("long").alias("alone"), prefix["h"].alias("listed")).where(F.size("listed") > 0)


class Lists:
    """Inverted lists over the sets of one block."""

    def __init__(self, sets: list[np.ndarray]):
        self.sets = sets
        self.sizes = np.array([len(s) for s in sets], np.int64)
        flat = np.concatenate(sets)
        owner = np.repeat(np.arange(len(sets)), self.sizes)
        order = np.argsort(flat, kind="stable")
        self.owners = owner[order]
        self.keys, self.starts = np.unique(flat[order], return_index=True)
        self.ends = np.append(self.starts[1:], len(flat))
        # Every (list, set) as one number, in order: what the long lists are probed in.
        self.places = np.repeat(np.arange(len(self.keys)), self.ends - self.starts) * len(sets) + self.owners

    def search(self, query: np.ndarray, percent: int) -> np.ndarray:
        """Sets of the block that are similar to the query, by DivideSkip.

        With L lists set aside, a similar set occurs in at least T - L of the others.
        """
        at = np.minimum(np.searchsorted(self.keys, query), len(self.keys) - 1)
        at = at[self.keys[at] == query]
        least = least_overlap(len(query), percent)
        if len(at) < least:
            return np.zeros(0, np.int64)
        length = self.ends[at] - self.starts[at]
        order = at[np.argsort(length, kind="stable")]
        aside = min(int(least / (MU * np.log2(max(2, int(length.max()))) + 1)), least - 1)
        short, long = order[:len(order) - aside], order[len(order) - aside:]
        sizes = self.ends[short] - self.starts[short]
        merged = self.owners[np.repeat(self.starts[short] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())]
        found, times = np.unique(merged, return_counts=True)
        keep = times >= least - aside
        keep &= (100 * self.sizes[found] >= percent * len(query)) & (100 * len(query) >= percent * self.sizes[found])
        found, times = found[keep], times[keep]
        left = len(long)
        for part in np.array_split(long, PROBES):
            if not len(found):
                break
            probes = part[:, None] * len(self.sets) + found[None, :]
            place = np.minimum(np.searchsorted(self.places, probes), len(self.places) - 1)
            times = times + (self.places[place] == probes).sum(axis=0)
            left -= len(part)
            able = times + left >= least
            found, times = found[able], times[able]
        union = self.sizes[found] + len(query) - times
        return found[100 * times >= percent * union]


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[dict[str, list]]:
    """The columns of each group of a table that is sorted by its keys."""
    now, rows = None, {}
    for batch in batches:
        columns = {n: batch.column(n).to_pylist() for n in batch.schema.names}
        own = list(zip(*(columns[k] for k in keys), strict=True))
        cuts = [0, *(i for i in range(1, len(own)) if own[i] != own[i - 1]), len(own)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if a == b:
                continue
            if own[a] != now:
                if now is not None:
                    yield rows
                now, rows = own[a], {n: [] for n in columns}
            for n, values in columns.items():
                rows[n] += values[a:b]
    if now is not None:
        yield rows


def _met(side: np.ndarray) -> np.ndarray:
    """Which rows of a group are compared: sides 0 and 1 with each other, side 2 with itself."""
    return (side[:, None] == 2) | (side[:, None] != side[None, :])


def _needed(group: dict[str, list], percent: int) -> np.ndarray:
    """The rows of a list that still have a partner to be compared with here.

    A pair is left out if it is connected, if its sizes or the places of the n-gram leave too little overlap, or if an earlier list
    (of the first `HEAD` of each class) has it too.
    """
    part, side, n, pos = (np.array(group[k]) for k in ("component", "side", "n", "pos"))
    rest = n - pos
    need = -(-percent * (n[:, None] + n[None, :]) // (100 + percent))
    open_ = _met(side) & (part[:, None] != part[None, :]) & (np.minimum(rest[:, None], rest[None, :]) >= need)
    open_ &= (100 * n[:, None] >= percent * n[None, :]) & (100 * n[None, :] >= percent * n[:, None])
    if open_.any():
        earlier = [h[:b] for h, b in zip(group["head"], group["before"], strict=True)]
        owner = np.repeat(np.arange(len(n)), [len(e) for e in earlier])
        if len(owner):
            seen, place = np.unique(np.concatenate([np.array(e, np.int64) for e in earlier]), return_inverse=True)
            there = np.zeros((len(n), len(seen)), np.float32)
            there[owner, place] = 1
            open_ &= there @ there.T == 0
    return open_.any(axis=1)


def _links(group: dict[str, list], percent: int) -> list[tuple[int, int]]:
    """Links of a group of rows (side, c, component, grams). Of the links between two components one is enough."""
    c, side = np.array(group["c"]), np.array(group["side"])
    part = group["component"]
    sets = [np.frombuffer(x, np.uint64) for x in group["grams"]]
    parent = {x: x for x in part}

    def root(x):
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    crossed = (side != 2).any()
    queries = np.flatnonzero(side == 1) if crossed else np.arange(len(c))
    others = np.flatnonzero(side == 0) if crossed else np.arange(len(c))
    out = []
    if len(others) and len(queries):
        lists = Lists([sets[i] for i in others])
        for q in queries:
            for i in others[lists.search(sets[q], percent)]:
                if (x := root(part[q])) != (y := root(part[i])):
                    parent[max(x, y)] = min(x, y)
                    out.append((int(min(c[q], c[i])), int(max(c[q], c[i]))))
    return out


def bitmap(grams: np.ndarray) -> bytes:
    """A bit for each hash bucket that holds an odd number of n-grams; at least four bits for each n-gram."""
    bits = 1 << max(6, int(4 * len(grams) - 1).bit_length())
    odd = np.bincount((grams & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def most_overlap(one: bytes, others: list[bytes], n: int, sizes: np.ndarray) -> np.ndarray:
    """No pair overlaps in more than half of what its sizes exceed the bits in which the bitmaps differ.

    A bitmap twice as long is folded: the buckets of the shorter one are pairs of its buckets.
    """
    out = np.zeros(len(others), np.int64)
    for k, other in enumerate(others):
        a, b = (np.frombuffer(x, np.uint64) for x in (one, other))
        while len(a) > len(b):
            a = a[:len(a) // 2] ^ a[len(a) // 2:]
        while len(b) > len(a):
            b = b[:len(b) // 2] ^ b[len(b) // 2:]
        out[k] = (n + sizes[k] - int(np.bitwise_count(a ^ b).sum())) // 2
    return out


def _near(group: dict[str, list], percent: int) -> np.ndarray:
    """The rows of a group whose bitmap leaves room for a similar row that is not connected to it yet."""
    part, side, n = (np.array(group[k]) for k in ("component", "side", "n"))
    pairs = np.triu(_met(side) & (part[:, None] != part[None, :]), 1)
    pairs &= (100 * n[:, None] >= percent * n[None, :]) & (100 * n[None, :] >= percent * n[:, None])
    keep = np.zeros(len(n), bool)
    for i in np.flatnonzero(pairs.any(axis=1)):
        others = np.flatnonzero(pairs[i])
        bound = most_overlap(group["bits"][i], [group["bits"][j] for j in others], int(n[i]), n[others])
        near = others[bound >= -(-percent * (n[i] + n[others]) // (100 + percent))]
        keep[near] = True
        keep[i] |= len(near) > 0
    return keep


def _only_near(members: DataFrame, keys: list[str], bitmaps: DataFrame, percent: int) -> DataFrame:
    """Members for which the sets themselves have to be compared. Bitmaps are an eighth of the sets' size."""
    names = [*keys, "side", "c", "component"]
    rows = members.join(bitmaps, "c").select(*names, "n", "bits")
    fields = [members.schema[x] for x in names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, keys):
            at = np.flatnonzero(_near(group, percent))
            if len(at):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.array(group[f.name])[at], pa.int32() if f.dataType.typeName() == "integer" else pa.int64()) for f in fields], names)

    return stored(rows.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, StructType(fields)), "near")


def _search(members: DataFrame, keys: list[str], sets: DataFrame, percent: int) -> DataFrame:
    """Links found in each group of members (keys, side, c, component); groups are bounded by the caller."""
    rows = members.join(sets.select("c", "grams"), "c").select(*keys, "side", "c", "component", "grams")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, keys):
            found = _links(group, percent)
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)], ["a", "b"])

    return rows.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, "a long, b long")


def _texts_of(docs: DataFrame, found: DataFrame) -> DataFrame:
    """(c, one, two, text) of the documents that may show the sets of classes (c, least_id, one, two)."""
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return texts.join(found, F.col("doc_id").eqNullSafe(F.col("least_id"))).select("c", "one", "two", "text")


def _fresh_sets(batch: pa.RecordBatch, seen: set[int], size: int) -> Iterator[tuple[int, np.ndarray]]:
    """The sets of the classes that have not been seen; a document with the same id may have another text."""
    fresh = [i for i, c in enumerate(batch.column("c").to_pylist()) if c not in seen]
    batch = batch.take(pa.array(fresh, pa.int64()))
    one, two, classes = (batch.column(k).to_pylist() for k in ("one", "two", "c"))
    for i, own in enumerate(shingle_sets(batch.column("text"), size)):
        if len(own) and classes[i] not in seen and _prints(own) == (one[i], two[i]):
            seen.add(classes[i])
            yield classes[i], own


def _sets_of(docs: DataFrame, classes: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """(c, n, grams, bits) of the wanted classes, from the text of one document each."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            found = list(_fresh_sets(batch, seen, size))
            yield pa.RecordBatch.from_arrays(
                [pa.array([c for c, _ in found], pa.int64()), pa.array([len(x) for _, x in found], pa.int64()),
                 pa.array([x.tobytes() for _, x in found], pa.binary()), pa.array([bitmap(x) for _, x in found], pa.binary())],
                ["c", "n", "grams", "bits"])

    found = classes.join(wanted.select("c").distinct(), "c", "left_semi").select("c", "least_id", "one", "two")
    return _texts_of(docs, found).mapInArrow(rows, "c long, n long, grams binary, bits binary")


def _blocks(counts: DataFrame, name: str) -> DataFrame:
    return counts.withColumn(name, F.ceil(F.col("k") / BLOCK).cast("int"))


def _star_members(lists: DataFrame) -> DataFrame:
    """Each class of a list with the list's centre, in blocks that hold the centre too."""
    centres = lists.groupBy("h").agg(F.min("c").alias("centre"))
    pairs = stored(lists.join(centres, "h").where(F.col("c") != F.col("centre")).select("c", "centre").distinct(), "pairs")
    blocks = _blocks(pairs.groupBy("centre").agg(F.count("*").alias("k")), "blocks")
    placed = pairs.join(blocks, "centre").withColumn("block", F.pmod(F.xxhash64("c"), F.col("blocks")).cast("int"))
    placed = placed.select("centre", "block", F.lit(0).alias("side"), "c", F.col("c").alias("component"))
    each = blocks.select("centre", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(1).alias("side"),
                         F.col("centre").alias("c"), F.col("centre").alias("component"))
    return placed.unionByName(each)


def _cross_members(prefixes: DataFrame, lists: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """Lists that still hold more than one component, each in blocks; every pair of blocks meets in one group."""
    labelled = lists.join(labels, lists["c"] == labels["node"], "left").select(
        "c", "h", "before", F.coalesce("label", "c").alias("component"))
    labelled = stored(labelled, "labelled")
    stats = labelled.groupBy("h").agg(F.count("*").alias("k"), F.min("component").alias("low"), F.max("component").alias("high"))
    # What the comparison needs of a class joins only here, where most lists are gone.
    heads = prefixes.select("c", "n", "alone", F.slice("listed", 1, HEAD).alias("head"))
    members = labelled.join(_blocks(stats.where("low < high"), "blocks").select("h", "blocks"), "h").join(heads, "c").withColumn(
        "pos", F.col("alone") + F.col("before")).withColumn("own", F.pmod(F.xxhash64("c"), F.col("blocks")).cast("int"))
    # A list of one block gives each member once, a list of B blocks B times.
    met = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    side = F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0).otherwise(1)
    keys = ["h", "i", "j"]
    rows = met.select("h", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), side.alias("side"), "c", "component",
                      "n", "pos", "before", "head")
    names = [*keys, "side", "c", "component"]
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, keys):
            at = np.flatnonzero(_needed(group, percent))
            if len(at):
                yield pa.RecordBatch.from_arrays([pa.array(np.array(group[x])[at], t) for x, t in zip(names, kinds, strict=True)], names)

    return stored(rows.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(
        run, "h long, i int, j int, side int, c long, component long"), "needed")


def similar_documents(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles and component_id of every row.

    Rows are linked if 100 times the overlap of their sets is at least `percent` times their union; equal sets are. A null text,
    or one without words, has an empty set and is linked with nothing. component_id is the smallest doc_id of the component, null ids left
    aside (a row without words keeps its own id). Repeated rows are copies like others.
    """
    rows = _set_rows(docs, size, percent)  # made twice: to keep the sets' low n-grams would cost half the input in disk
    classes = stored(rows.where("n > 0").groupBy("one", "two", "n").agg(
        F.min("doc_id").alias("least_id"), F.first("spare").alias("spare"), F.first("below").alias("below"), F.first("low").alias("low")).withColumn(
        "c", F.monotonically_increasing_id()), "classes")
    whole, counts, heavy = heavy_last(docs, classes, size, percent)
    prefixes = stored(short_lists(whole, percent, counts, heavy), "prefixes")
    lists = prefixes.select("c", F.posexplode("listed").alias("before", "h"))
    lists = stored(lists.join(lists.groupBy("h").agg(F.count("*").alias("k")).where("k > 1").select("h"), "h", "left_semi"), "lists")
    sets = stored(_sets_of(docs, classes, lists, size), "grams")
    bitmaps, star, keys = sets.select("c", "n", "bits"), ["centre", "block"], ["h", "i", "j"]
    stars = stored(_search(_only_near(_star_members(lists), star, bitmaps, percent), star, sets, percent), "stars")
    near = _only_near(_cross_members(prefixes, lists, components(stars), percent), keys, bitmaps, percent)
    crossed = stored(_search(near, keys, sets, percent), "crossed")
    labels = components(stars.unionByName(crossed))
    known = classes.select("c", "one", "two", "n", "least_id").join(labels, classes["c"] == labels["node"], "left").withColumn(
        "label", F.coalesce("label", "c"))
    least = known.groupBy("label").agg(F.min("least_id").alias("component_id"))
    named = known.join(least, "label").select("one", "two", F.col("n").alias("_n"), "component_id")
    got = rows.select("doc_id", "n", "one", "two").join(
        named.withColumnsRenamed({"one": "_one", "two": "_two"}),
        (F.col("one") == F.col("_one")) & (F.col("two") == F.col("_two")) & (F.col("n") == F.col("_n")), "left")
    own = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return got.select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"))


def one_of_each(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The rows of `docs` that stay when one document of each component is kept: the one with the smallest id.

    Rows without words stay. Of repeated rows with the kept id and the same text one stays.
    """
    kept = similar_documents(docs, size, percent).where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    kept = kept.groupBy(F.col("doc_id").alias("kept")).agg(F.max("n_shingles").alias("most"))
    # The row travels as one value, so that no name of its columns can clash.
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").alias("id"),
                       F.xxhash64(F.col("text").cast("string")).alias("print"))
    found = rows.join(kept, F.col("id").eqNullSafe(F.col("kept")))
    rank = F.row_number().over(Window.partitionBy("id", "print").orderBy(F.lit(1)))
    return found.withColumn("rank", rank).where((F.col("rank") == 1) | (F.col("most") == 0)).select("row.*")
