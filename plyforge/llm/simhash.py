"""Near copies by SimHash: documents whose 64-bit fingerprints differ in few bits, as connected components.

1. A fingerprint holds, bit by bit, the majority of the hashes of a text's word shingles. Equal fingerprints form one node.
2. Covering locality-sensitive hashing: every bit position gets a vector of `radius` + 1 bits, and every nonzero vector v of that length
   one table, whose mask keeps the positions with an odd inner product with v. The vectors of at most `radius` differing
   positions span less than the whole space, so some v is orthogonal to them all: in its table the two fingerprints collide. There are
   2^(radius+1) - 1 tables (15 for a radius of 3), each of half the bits; no pair within the radius is missed.
3. A bucket of at most `BUCKET` fingerprints is compared in memory and gives links that span its components. A larger one is split
   again, exactly: the bits that its mask leaves open are cut into `radius` + 1 parts, and a pair within the radius agrees in
   one of them. Each level has fewer open bits and ends where a bucket cannot hold more than `BUCKET` fingerprints, so
   the work grows with the number of fingerprints whatever the size of a bucket.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plyforge.llm.components import components
from plyforge.sources.paths import stored

BITS, RADIUS, SHINGLE, SEED = 64, 3, 3, 42
BUCKET = 2048
PIECE = 1 << 20
_SPACE = bytes.maketrans(b"\t\n\v\f\r" + bytes(range(65, 91)), b"     " + bytes(range(97, 123)))


def _pieces(text: memoryview) -> Iterator[list[bytes]]:
    """The words of a text, about a megabyte at a time; A-Z become a-z."""
    rest = b""
    for at in range(0, len(text), PIECE):
        piece = rest + bytes(text[at:at + PIECE]).translate(_SPACE)
        cut = len(piece) if at + PIECE >= len(text) else piece.rfind(b" ") + 1
        rest = piece[cut:]
        yield piece[:cut].split()


def shingle_hashes(text: memoryview, size: int = SHINGLE, seed: int = SEED) -> Iterator[np.ndarray]:
    """XXH64 of every shingle of a text, repeats included, a piece at a time. A text of fewer words is one shingle, one without has none."""
    before: list[bytes] = []
    count = 0
    for own in _pieces(text):
        count += len(own)
        words = before + own
        joined = map(b" ".join, zip(*(words[k:] for k in range(size)), strict=False))
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, joined, repeat(seed)), np.uint64)
        if len(hashes):
            yield hashes
        before = words[max(0, len(words) - size + 1):]
    if 0 < count < size:
        yield np.array([xxhash.xxh64_intdigest(b" ".join(before), seed)], np.uint64)


def fingerprint(text: memoryview, size: int = SHINGLE, seed: int = SEED) -> int:
    """A bit is 1 if more than half of the shingles' hashes have it. Zero without words."""
    total, ones = 0, np.zeros(BITS, np.int64)
    for hashes in shingle_hashes(text, size, seed):
        for part in np.array_split(hashes, len(hashes) // 8192 + 1):
            total += len(part)
            ones += np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > total, bitorder="little").tobytes(), "little")


def covering_masks(bits: int = BITS, radius: int = RADIUS) -> list[int]:
    """One mask for each nonzero vector. The positions' vectors run through all nonzero ones in turn, so that masks are of about equal weight."""
    size = 1 << (radius + 1)
    vector = [1 + i % (size - 1) for i in range(bits)]
    return [sum(1 << i for i in range(bits) if (vector[i] & v).bit_count() & 1) for v in range(1, size)]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def split_mask(mask: int, radius: int = RADIUS) -> list[int]:
    """The mask with one of `radius` + 1 parts of the open bits added: finer masks that cover what the mask covers."""
    free = [i for i in range(BITS) if not mask >> i & 1]
    return [mask | sum(1 << i for i in free[k::radius + 1]) for k in range(radius + 1)]


def fingerprints(docs: DataFrame, size: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """(doc_id, print) of every row; the print as a signed long."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("text")
            found = np.zeros(len(column), np.uint64)
            for i in range(len(column)):
                if column[i].is_valid:
                    found[i] = fingerprint(memoryview(column[i].as_buffer()), size, seed)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found.view(np.int64))], ["doc_id", "print"])

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(rows, f"doc_id {kind}, print long")


def spanning_links(prints: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what pairs within the radius connect: a breadth-first search that compares each print once with all others."""
    left = np.ones(len(prints), bool)
    from_, to = [], []
    while left.any():
        queue = [int(np.argmax(left))]
        left[queue[0]] = False
        while queue:
            at = queue.pop()
            rest = np.flatnonzero(left)
            if not len(rest):
                break
            near = rest[np.bitwise_count(prints[rest] ^ prints[at]) <= radius]
            left[near] = False
            from_.append(np.full(len(near), prints[at]))
            to.append(prints[near])
            queue += near.tolist()
    none = [np.zeros(0, np.uint64)]
    return np.concatenate(none + from_), np.concatenate(none + to)


def _links(members: DataFrame, radius: int) -> DataFrame:
    """(a, b) from the members (mask, key, print) of buckets, which are bounded by the caller."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for batch in batches:
            rows = np.stack([batch.column(k).to_numpy() for k in ("mask", "key", "print")])
            held.append(rows)
            table = np.concatenate(held, axis=1)
            cuts = np.flatnonzero((table[:2, 1:] != table[:2, :-1]).any(axis=0)) + 1
            # The last bucket of a batch may go on in the next one.
            held = [table[:, cuts[-1]:] if len(cuts) else table]
            if len(cuts):
                yield _found(table[2, :cuts[-1]], np.concatenate([[0], cuts]), radius)
        if held:
            yield _found(held[0][2], np.array([0, held[0].shape[1]]), radius)

    return members.repartition("mask", "key").sortWithinPartitions("mask", "key").mapInArrow(run, "a long, b long")


def _found(prints: np.ndarray, cuts: np.ndarray, radius: int) -> pa.RecordBatch:
    found = [spanning_links(prints[a:b].view(np.uint64), radius) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate([f[k] for f in found]).view(np.int64)) for k in (0, 1)], ["a", "b"])


def _members(prints: DataFrame, masks: Column) -> DataFrame:
    """A member of a bucket for each mask of each print."""
    rows = prints.select("print", F.explode(masks).alias("mask"))
    return rows.select("mask", F.col("print").bitwiseAND(F.col("mask")).alias("key"), "print")


def linked_prints(prints: DataFrame, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """(a, b): links between distinct prints (a stored table) within the radius; they connect all that such pairs connect."""
    if bucket < 1 << radius:
        raise ValueError("a bucket must be able to hold all prints that differ in no more bits than the radius")
    masks = covering_masks(BITS, radius)
    members = _members(prints, F.array(*[F.lit(_signed(m)) for m in masks]))
    links = None
    while True:
        # Single prints, by far the most, end here, before anything but the counts is shuffled for them.
        sizes = stored(members.groupBy("mask", "key").agg(F.count("*").alias("n")).where("n > 1"), "sizes")
        met = stored(members.join(sizes, ["mask", "key"]), "members")
        small = stored(_links(met.where(F.col("n") <= bucket).select("mask", "key", "print"), radius), "links")
        links = small if links is None else links.unionByName(small)
        large = met.where(F.col("n") > bucket)
        # One row for each mask: no more than masks times the parts of a level.
        masks = [r["mask"] for r in sizes.where(F.col("n") > bucket).select("mask").distinct().collect()]
        if not masks:
            return links
        finer: Column | None = None
        for m in masks:
            parts = F.array(*[F.lit(_signed(p)) for p in split_mask(m % (1 << 64), radius)])
            finer = F.when(F.col("mask") == m, parts) if finer is None else finer.when(F.col("mask") == m, parts)
        members = _members(large.select("print", "mask", finer.alias("finer")), F.col("finer"))


def near_documents(docs: DataFrame, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id of every row.

    Rows whose fingerprints differ in at most `radius` bits are linked; component_id is the smallest doc_id that can be reached, null
    ids left aside (null if there is no other). A null or empty text, or one without words, has the fingerprint zero, which is linked like
    any other. Texts are read whole, in pieces. Repeated rows are copies; an empty table gives no rows; other columns are not looked at.
    """
    rows = stored(fingerprints(docs), "prints")
    nodes = stored(rows.groupBy("print").agg(F.min("doc_id").alias("least")), "nodes")
    labels = components(linked_prints(nodes.select("print"), radius, bucket))
    known = nodes.join(labels, nodes["print"] == labels["node"], "left").select("print", "least", F.coalesce("label", "print").alias("label"))
    least = known.groupBy("label").agg(F.min("least").alias("component_id"))
    named = known.join(least, "label").select(F.col("print").alias("p"), "component_id")
    return rows.join(named, F.col("print") == F.col("p")).select(
        "doc_id", F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), "component_id")
