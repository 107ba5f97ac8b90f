"""Benchmark decontamination: BM25 over an index of test items with list and block maxima, then an overlap check.

Items are indexed by length: those of at most `PASSAGE` words, of at most twice as many, and so on up to the longest one. For each of these
classes every training document is cut into passages of that many words that overlap by half, and each passage is a query. The weight of a term
in an item is its BM25 weight divided by the item's own score. A copy of an item lies in two passages next to each other, so one of
them has half of its score at least: one threshold fits long and short items. Bounds skip work as in
block-max WAND, for many passages at a time: the sum of a passage's list maxima must reach the threshold, then
the sum of block maxima for a block of items, and only items in such blocks are scored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plyforge.llm.texts import breaks_at_symbols, mix, words
from plyforge.sources.paths import stored

PASSAGE = 64
K1, B = 1.2, 0.75
THRESHOLD, OVERLAP = 0.5, 0.5
GRAM = 3
BLOCK = 16
POSTINGS_PER_SHARD = 1_000_000
CELLS = 4_000_000
SLACK = 1e-5

TERMS = "item long, item_id {id}, term long, tf int, size int"
SEQUENCES = "item long, question binary, answer binary"


class Index(NamedTuple):
    """Items by number, terms by sorted hash; postings and block maxima follow each other term by term."""

    item_ids: list
    vocabulary: np.ndarray
    list_max: np.ndarray
    postings: np.ndarray
    items: np.ndarray
    weights: np.ndarray
    block_starts: np.ndarray
    blocks: np.ndarray
    block_max: np.ndarray
    questions: list[np.ndarray]
    answers: list[np.ndarray]
    passage: int


def split_item(text: str) -> tuple[str, str]:
    """Question and answer of an item: the answer is the last line, or the last sentence of a single line.

    An item of one sentence is its own question and answer.
    """
    text = text.strip()
    head, _, tail = text.rpartition("\n")
    if not head:
        cut = text.rstrip(".!? ").rfind(". ")
        head, tail = (text[:cut + 1], text[cut + 2:]) if cut >= 0 else ("", text)
    return (head, tail) if any(c.isalnum() for c in head) and any(c.isalnum() for c in tail) else (text, text)


def grams(hashes: np.ndarray, size: int = GRAM) -> np.ndarray:
    """Distinct hashes of runs of `size` words; a shorter sequence is one run."""
    size = min(size, len(hashes))
    if not size:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(hashes) - size + 1, np.uint64)
    for k in range(size):
        out = mix(out + hashes[k:len(hashes) - size + 1 + k])
    return np.unique(out)


def _hash_lists(values: list[str]) -> list[np.ndarray]:
    out: list[np.ndarray] = []
    for group in words(pa.array(values, pa.string()), breaks_at_symbols(), lower=True):
        edges = np.searchsorted(group.text, np.arange(group.first, group.last + 1))
        out += [group.hash[a:b] for a, b in zip(edges[:-1], edges[1:], strict=True)]
    return out


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(item, item_id, text) to one row per item and distinct term."""
    for batch in batches:
        rows, terms, counts, sizes = [], [], [], []
        for i, hashes in enumerate(_hash_lists([x or "" for x in batch.column("text").to_pylist()])):
            term, count = np.unique(hashes, return_counts=True)
            rows += [i] * len(term)
            terms.append(term.view(np.int64))
            counts.append(count)
            sizes += [len(hashes)] * len(term)
        at = pa.array(rows, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column("item").take(at), batch.column("item_id").take(at),
             pa.array(np.concatenate([np.zeros(0, np.int64), *terms])),
             pa.array(np.concatenate([np.zeros(0, np.int32), *counts]).astype(np.int32)), pa.array(sizes, pa.int32())],
            ["item", "item_id", "term", "tf", "size"])


def _sequences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        parts = [split_item(x or "") for x in batch.column("text").to_pylist()]
        sides = [[h.tobytes() for h in _hash_lists([p[k] for p in parts])] for k in (0, 1)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("item"), *(pa.array(s, pa.binary()) for s in sides)], ["item", "question", "answer"])


def _weights(items: DataFrame) -> DataFrame:
    """item, item_id, passage, term and the BM25 weight as a share of the item's own score; statistics over all items.

    `passage` is the least doubling of `PASSAGE` that holds the item.
    """
    kind = items.schema["item_id"].dataType.simpleString()
    terms = stored(items.mapInArrow(_terms, TERMS.format(id=kind)), "terms")
    totals = terms.groupBy("item").agg(F.first("size").alias("size")).agg(
        F.count("*").alias("items"), F.avg("size").alias("mean_size"))
    with_df = terms.join(terms.groupBy("term").agg(F.count("*").alias("df")), "term").join(F.broadcast(totals))
    idf = F.log(1 + (F.col("items") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    gain = F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("size") / F.col("mean_size")))
    weighed = with_df.withColumn("weight", idf * gain)
    own = weighed.groupBy("item").agg(F.sum("weight").alias("own"))
    fits = F.ceil(F.log2(F.ceil(F.greatest("size", F.lit(PASSAGE)) / PASSAGE)))
    passage = F.pow(F.lit(2), fits).cast("long") * PASSAGE
    return stored(weighed.join(own, "item").select("item", "item_id", passage.alias("passage"), "term", (F.col("weight") / F.col("own")).alias("weight")),
                  "weights")


def indexes(benchmark: DataFrame) -> Iterator[Index]:
    """Indexes of shards of the items of each length class, each of about `POSTINGS_PER_SHARD` postings, one after another on the driver.

    Repeated items count once; items without words are never found.
    """
    items = benchmark.select("item_id", F.col("text").cast("string").alias("text")).distinct().withColumn(
        "item", F.xxhash64("item_id", "text"))
    items = stored(items.select("item", "item_id", "text"), "items")
    weights = _weights(items)
    sequences = items.select("item", "text").mapInArrow(_sequences, SEQUENCES)
    # One row for each doubling of the length.
    for passage, count in weights.groupBy("passage").count().orderBy("passage").collect():
        shards = -(-count // POSTINGS_PER_SHARD)
        for k in range(shards):
            own = F.pmod(F.col("item"), F.lit(shards)) == k
            held = weights.where(own & (F.col("passage") == passage))
            posted = held.orderBy("item", "term").toArrow()
            if posted.num_rows:
                texts = sequences.where(own).join(held.select("item").distinct(), "item", "left_semi").toArrow()
                yield build_index(posted, dict(zip(texts.column("item").to_pylist(), zip(
                    texts.column("question").to_pylist(), texts.column("answer").to_pylist(), strict=True), strict=True)), passage)


def build_index(posted: pa.Table, texts: dict[int, tuple[bytes, bytes]], passage: int) -> Index:
    """From rows (item, item_id, term, weight) in order of the item."""
    keys, first, number = np.unique(posted.column("item").to_numpy(), return_index=True, return_inverse=True)
    ids = posted.column("item_id").take(pa.array(first)).to_pylist()
    vocabulary, term = np.unique(posted.column("term").to_numpy().astype(np.int64).view(np.uint64), return_inverse=True)
    weight = posted.column("weight").to_numpy().astype(np.float64)
    order = np.lexsort((number, term))
    term, number, weight = term[order], number[order], weight[order]
    block = number // BLOCK
    new = np.flatnonzero(np.concatenate([[True], (np.diff(term) != 0) | (np.diff(block) != 0)]))
    starts = np.arange(len(vocabulary) + 1)
    sides = [[np.frombuffer(texts[int(k)][s], np.uint64) for k in keys] for s in (0, 1)]
    return Index(ids, vocabulary, np.maximum.reduceat(weight, np.searchsorted(term, starts[:-1])),
                 np.searchsorted(term, starts), number, weight, np.searchsorted(term[new], starts), block[new],
                 np.maximum.reduceat(weight, new), *sides, passage)


def _spread(starts: np.ndarray, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each term all positions of its stretch, and the number of the term they belong to."""
    sizes = starts[terms + 1] - starts[terms]
    owner = np.repeat(np.arange(len(terms)), sizes)
    return starts[terms][owner] + np.arange(len(owner)) - (np.cumsum(sizes) - sizes)[owner], owner


def _retrieved(index: Index, passage: np.ndarray, term: np.ndarray, count: int) -> Iterator[tuple[int, int, float]]:
    """(passage, item, score) at or above the threshold, from distinct (passage, term) pairs in order of the passage."""
    blocks, items = -(-len(index.item_ids) // BLOCK), len(index.item_ids)
    step = max(1, CELLS // max(blocks, 1))
    for low in range(0, count, step):
        a, b = np.searchsorted(passage, (low, low + step))
        at, own = passage[a:b] - low, term[a:b]
        where, owner = _spread(index.block_starts, own)
        bound = np.bincount(at[owner] * blocks + index.blocks[where], index.block_max[where], min(step, count - low) * blocks)
        alive = bound >= THRESHOLD - SLACK
        if not alive.any():
            continue
        busy = alive.reshape(-1, blocks).any(axis=1)[at]
        at, own = at[busy], own[busy]
        where, owner = _spread(index.postings, own)
        item = index.items[where]
        scored = alive[at[owner] * blocks + item // BLOCK]
        cell, inverse = np.unique(at[owner][scored] * items + item[scored], return_inverse=True)
        score = np.bincount(inverse, index.weights[where][scored], len(cell))
        for k in np.flatnonzero(score >= THRESHOLD):
            yield low + int(cell[k] // items), int(cell[k] % items), float(score[k])


def _share(there: np.ndarray, wanted: np.ndarray) -> float:
    """The share of the runs of `wanted` words that stand in `there`."""
    return float(np.isin(grams(wanted), grams(there, min(GRAM, len(wanted)))).mean()) if len(wanted) else 0.0


def leaks(column: pa.Array, index: Index) -> list[tuple[int, int, float, float, float]]:
    """(row, item, score, question overlap, answer overlap) of each text and item found in one of its passages.

    Overlap is the share of the item's word trigrams (all its words, if fewer) that stand in the passage or within a passage's half on either side.
    """
    found: dict[tuple[int, int], tuple[float, float, float]] = {}
    step = index.passage // 2
    for group in words(column, breaks_at_symbols(), lower=True):
        text = group.text - group.first
        sizes = np.bincount(text, minlength=group.last - group.first)
        starts = np.cumsum(sizes) - sizes
        halves = -(-sizes // step)
        half_starts = np.cumsum(halves) - halves
        owner = np.repeat(np.arange(len(sizes)), halves)
        half = half_starts[text] + (np.arange(len(text)) - starts[text]) // step
        place = np.minimum(np.searchsorted(index.vocabulary, group.hash), len(index.vocabulary) - 1)
        known = index.vocabulary[place] == group.hash
        term, half = place[known], half[known]
        bound = np.bincount(half, index.list_max[term], len(owner))
        follows = np.zeros(len(owner), bool)
        follows[:-1] = owner[1:] == owner[:-1]
        both = bound.copy()
        both[:-1] += np.where(follows[:-1], bound[1:], 0)
        # The last half of a longer text lies in the passage before it.
        both[1:][~follows[1:] & follows[:-1]] = 0
        candidates = np.flatnonzero(both >= THRESHOLD - SLACK)
        if not len(candidates):
            continue
        number = np.full(len(owner) + 1, -1)
        number[candidates] = np.arange(len(candidates))
        first = number[half]
        second = np.where((half > 0) & follows[half - 1], number[half - 1], -1)
        pairs = np.concatenate([(p * len(index.vocabulary) + term)[p >= 0] for p in (first, second)])
        pairs = np.unique(pairs)
        for p, item, score in _retrieved(index, pairs // len(index.vocabulary), pairs % len(index.vocabulary), len(candidates)):
            at = int(candidates[p])
            row = int(owner[at])
            begin = (at - int(half_starts[row])) * step
            low, high = max(0, begin - step), min(int(sizes[row]), begin + index.passage + step)
            there = group.hash[starts[row] + low:starts[row] + high]
            new = (score, _share(there, index.questions[item]), _share(there, index.answers[item]))
            key = (group.first + row, item)
            found[key] = tuple(map(max, new, found.get(key, new)))
    return [(*k, *v) for k, v in sorted(found.items())]


def confirmed(hits: list, overlap: float = OVERLAP) -> list:
    """The hits whose question and answer both overlap."""
    return [h for h in hits if h[3] >= overlap and h[4] >= overlap]


def contaminated_pairs(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, score, question_overlap, answer_overlap of every confirmed leak, one row for each row of `docs` and item.

    Null and empty texts hold no leak. Repeated documents each give their rows. Without items there are no rows. Each index is
    broadcast for a pass whose few rows are stored, and then destroyed, so that one is alive at a time.
    """
    kind, item_kind = (df.schema[c].dataType.simpleString() for df, c in ((docs, "doc_id"), (benchmark, "item_id")))
    schema = f"doc_id {kind}, item_id {item_kind}, score double, question_overlap double, answer_overlap double"
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    out = docs.sparkSession.createDataFrame([], schema)
    for index in indexes(benchmark):
        sent = docs.sparkSession.sparkContext.broadcast(index)
        out = out.unionByName(stored(rows.mapInArrow(_pair_scan(sent), schema), "leaks"))
        sent.destroy()
    return out


def _pair_scan(sent):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hits = confirmed(leaks(batch.column("text"), sent.value))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array([h[0] for h in hits], pa.int64())),
                 pa.array([sent.value.item_ids[h[1]] for h in hits], None if hits else pa.int64()),
                 *(pa.array([h[k] for h in hits], pa.float64()) for k in (2, 3, 4))],
                ["doc_id", "item_id", "score", "question_overlap", "answer_overlap"])

    return scan


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows that hold no confirmed leak, with all their columns. Null and empty texts stay."""
    kept = docs
    for index in indexes(benchmark):
        sent = docs.sparkSession.sparkContext.broadcast(index)
        kept = kept.mapInArrow(_clean_scan(sent), kept.schema)
    return kept


def _clean_scan(sent):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.ones(batch.num_rows, bool)
            keep[[h[0] for h in confirmed(leaks(batch.column("text").cast(pa.string()), sent.value))]] = False
            yield batch.filter(pa.array(keep))

    return scan
