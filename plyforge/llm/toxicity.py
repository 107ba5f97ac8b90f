"""A small convolutional text classifier over hashed word embeddings, trained in numpy.

A word's embedding is the sum of a row for the word and a row for its first four bytes. Buckets that were seen in fewer
than `LEAST_DOCS` fitting documents share one row. Filters of widths 1 to 3 slide over the words, the largest response of
each filter is kept, and a linear layer turns these into a logit. A threshold for each language (told from function words
of the text, never from a column) is subtracted, so that a score of 0.7 means the same in every language.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from plyforge.llm.texts import breaks_at_symbols, word_hashes, words
from plyforge.sources.paths import stored

WIDTHS, FILTERS, SIZE = (1, 2, 3), 4, 8
WORD_BITS, HEAD_BITS, HEAD = 21, 18, 4
LEAST_DOCS = 4
#: Labelled documents are fitted in shards of about so many, or of so many words, whose weights are averaged.
SHARD_DOCS, SHARD_WORDS = 4096, 1 << 23
#: 64-bit words of the bitmap that leaves out texts without a label.
BITMAP_WORDS = 1 << 17
#: Words of a step beside the document that passes the bound.
STEP_WORDS = 1 << 18
#: Words after which `_hash_rows` leaves out a text if it is not told otherwise; `train` hashes texts whole.
MOST_WORDS = 8000
THRESHOLD = 0.7
EPOCHS, BATCH, RATE = 3, 32, 0.02
TUNING_SHARE, LEAST_TUNED = 4, 40
#: Logits are counted for the thresholds in steps of 1 / LOGIT_STEPS up to a size of LOGIT_END; changes of weights are added up as multiples of
#: 1 / UNIT, so that the sum does not depend on the order.
LOGIT_STEPS, LOGIT_END, UNIT = 256, 64, 2.0**40

#: Function words that tell a language. Fixed values.
FUNCTION_WORDS = {
    "en": ("the", "and", "of", "to", "is", "that", "with", "was", "for"),
    "de": ("der", "die", "und", "das", "ist", "den", "mit", "nicht", "von"),
    "fr": ("le", "les", "des", "et", "du", "une", "sur", "pour", "est"),
    "es": ("el", "los", "las", "del", "y", "una", "por", "para", "con"),
}
LANGUAGES = (*FUNCTION_WORDS, "other")


class Model(NamedTuple):
    """Rows of the maps: 0 stands for padding, 1 for every bucket that has no row."""

    word_map: np.ndarray
    head_map: np.ndarray
    words: np.ndarray
    heads: np.ndarray
    language: np.ndarray
    filters: list[np.ndarray]
    biases: list[np.ndarray]
    out: np.ndarray
    out_bias: float
    thresholds: np.ndarray


def _bucket(hashes: np.ndarray, bits: int) -> np.ndarray:
    """The bucket of each 64-bit hash; numbers of 32 bits are buckets already."""
    return hashes if hashes.dtype == np.uint32 else (hashes >> np.uint64(64 - bits)).astype(np.int64)


def _pooled(model: Model, rows: np.ndarray, heads: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, list]:
    """The largest response of each filter in each document, and the position where it is.

    `rows` has two padding rows after each document, so that no filter reaches into the next one.
    """
    x = model.words[rows] + model.heads[heads]
    x[rows == 0] = 0
    got, where = [], []
    for width, filters, bias in zip(WIDTHS, model.filters, model.biases, strict=True):
        z = x @ filters[:SIZE]
        for k in range(1, width):
            z[:-k] += x[k:] @ filters[k * SIZE:(k + 1) * SIZE]
        # A window that starts in the padding would end in the next document.
        z[rows == 0] = 0
        got.append(np.maximum(np.maximum.reduceat(z, starts, axis=0) + bias, 0))
        where.append(z)
    return np.concatenate(got, axis=1), [x, *where]


def _padded(docs: np.ndarray, count: int, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """The values with two zeros after each of `count` documents, and where each document starts."""
    sizes = np.bincount(docs, minlength=count)
    starts = np.cumsum(sizes + 2) - sizes - 2
    at = np.arange(len(docs)) + 2 * docs
    out = []
    for value in values:
        wide = np.zeros(len(docs) + 2 * count, value.dtype)
        wide[at] = value
        out.append(wide)
    return starts, *out


def _logits(model: Model, docs: np.ndarray, count: int, words_: np.ndarray, heads: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Logit and language of each document."""
    rows = model.word_map[_bucket(words_, WORD_BITS)]
    spoken = np.bincount(docs * 5 + model.language[rows], minlength=5 * count).reshape(count, 5)
    said = spoken[:, :4]
    language = np.where(said.max(axis=1) > 0, said.argmax(axis=1), 4)
    starts, rows, head_rows = _padded(docs, count, rows, model.head_map[_bucket(heads, HEAD_BITS)])
    pooled, _ = _pooled(model, rows, head_rows, starts)
    return pooled @ model.out + model.out_bias, language


def scores_of(logits: np.ndarray, language: np.ndarray, thresholds: np.ndarray) -> np.ndarray:
    shifted = logits.astype(np.float64) - thresholds[language] + np.log(THRESHOLD / (1 - THRESHOLD))
    return 1 / (1 + np.exp(-np.clip(shifted, -40, 40)))


def score_column(model: Model, column: pa.Array) -> np.ndarray:
    """Scores of a column of texts."""
    scores = np.zeros(len(column))
    for group in words(column, breaks_at_symbols(), HEAD, lower=True):
        logits, language = _logits(model, group.text - group.first, group.last - group.first, group.hash, group.head)
        scores[group.first:group.last] = scores_of(logits, language, model.thresholds)
    return scores


def _seen(texts: Iterable[np.ndarray], toxic: Iterable[bool], bits: int, counts: np.ndarray | None = None) -> np.ndarray:
    """[label, bucket]: the texts of either label that have the bucket, added to `counts`."""
    counts = np.zeros((2, 1 << bits), np.int64) if counts is None else counts
    for own, label in zip(texts, toxic, strict=True):
        counts[int(label), np.unique(_bucket(own, bits))] += 1
    return counts


def _evidence(counts: np.ndarray, docs: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Row map of the buckets that enough texts have, and the cautious log odds of each row (a lower bound if positive).

    `docs` are all texts by label.
    """
    enough = np.flatnonzero(counts.sum(axis=0) >= LEAST_DOCS)
    good, bad = counts[:, enough] + 0.5
    odds = np.log(bad / good) - np.log((docs[1] + 1) / (docs[0] + 1))
    doubt = 1.5 * np.sqrt(1 / bad + 1 / good)
    table = np.ones(counts.shape[1], np.int32)
    table[enough] = np.arange(2, 2 + len(enough), dtype=np.int32)
    return table, np.concatenate([[0, 0], np.sign(odds) * np.maximum(np.abs(odds) - doubt, 0)])


def _untrained(word_counts: np.ndarray, head_counts: np.ndarray, docs: tuple[int, int], rng: np.random.Generator) -> Model:
    """The model that training starts from; without documents of both labels it scores every text alike, below the threshold."""
    word_map, word_odds = _evidence(word_counts, docs)
    head_map, head_odds = _evidence(head_counts, docs)
    tables = []
    for odds in (word_odds, head_odds):
        table = rng.normal(0, 0.02, (len(odds), SIZE)).astype(np.float32)
        table[:, 0] = odds / 2
        tables.append(table)
    tables[0][0] = tables[1][0] = 0
    language = np.full(len(word_odds), 4, np.int8)
    extra = []
    for k, name in enumerate(FUNCTION_WORDS):
        for h in word_hashes(" ".join(FUNCTION_WORDS[name]), breaks_at_symbols()).hash:
            b = int(_bucket(np.array([h]), WORD_BITS)[0])
            if word_map[b] == 1:
                word_map[b] = len(language) + len(extra)
                extra.append(k)
            else:
                language[word_map[b]] = k
    if extra:
        language = np.concatenate([language, np.array(extra, np.int8)])
        tables[0] = np.concatenate([tables[0], np.zeros((len(extra), SIZE), np.float32)])
    filters = [rng.normal(0, 0.05, (w * SIZE, FILTERS)).astype(np.float32) for w in WIDTHS]
    filters[0][0, 0] = 1
    for w, f in zip(WIDTHS, filters, strict=True):
        f[::SIZE, 1] = 1 / w
    out = np.concatenate([[1, 0.3, 0.05, 0.05], [0.05, 0.3, 0.05, 0.05], [0.05, 0.3, 0.05, 0.05]]).astype(np.float32)
    model = Model(word_map, head_map, tables[0], tables[1], language, filters,
                  [np.zeros(FILTERS, np.float32) for _ in WIDTHS], out, -2.0, np.full(len(LANGUAGES), 3.0))
    return model if min(docs) else model._replace(out=np.zeros_like(out))


def _logit(model: Model, own: np.ndarray, heads: np.ndarray) -> tuple[float, int]:
    logits, language = _logits(model, np.zeros(len(own), np.int64), 1, own, heads)
    return float(logits[0]), int(language[0])


def fit(texts: list[tuple[bool, np.ndarray, np.ndarray]], seed: int = 7) -> Model:
    """A model from (label, word hashes, head hashes) of each fitting document, or their buckets; deterministic for a given order.

    This is `train` for documents that one process holds. A fourth of them is kept back from the weights and used for the
    thresholds. Without documents of both labels the model scores every text alike, below the threshold.
    """
    toxic = np.array([t[0] for t in texts], bool)
    rng = np.random.default_rng(seed)
    tuning = np.arange(len(texts)) % TUNING_SHARE == 0 if len(texts) >= LEAST_TUNED else np.zeros(len(texts), bool)
    fitting = np.flatnonzero(~tuning)
    docs = int((~toxic[fitting]).sum()), int(toxic[fitting].sum())
    model = _untrained(*(_seen([texts[i][k] for i in fitting], toxic[fitting], bits)
                         for k, bits in ((1, WORD_BITS), (2, HEAD_BITS))), docs, rng)
    if not toxic.any() or toxic.all():
        return model._replace(out=np.zeros_like(model.out))
    model = _train(model, [texts[i] for i in fitting], rng)
    shown = np.flatnonzero(tuning) if tuning.any() else fitting
    got = [_logit(model, *texts[i][1:]) for i in shown]
    return model._replace(thresholds=_thresholds(
        np.array([z for z, _ in got]), np.array([k for _, k in got]), toxic[shown], np.ones(len(got), np.int64)))


def _train(model: Model, texts: list, rng: np.random.Generator) -> Model:
    """Adagrad on the log loss; gradients flow through the position of each filter's largest response."""
    out_bias = model.out_bias
    sums = {k: np.full(a.shape, 0.1, np.float32) for k, a in (
        ("words", model.words), ("heads", model.heads), ("out", model.out),
        *((f"f{i}", f) for i, f in enumerate(model.filters)), *((f"b{i}", b) for i, b in enumerate(model.biases)))}

    def step(name: str, value: np.ndarray, grad: np.ndarray, at=slice(None)) -> None:
        sums[name][at] += grad * grad
        value[at] -= RATE * grad / np.sqrt(sums[name][at])

    for _ in range(EPOCHS):
        order = rng.permutation(len(texts))
        for batch in _steps(texts, order):
            label = np.array([t[0] for t in batch], np.float32)
            docs = np.repeat(np.arange(len(batch)), [len(t[1]) for t in batch])
            rows = model.word_map[_bucket(np.concatenate([t[1] for t in batch]), WORD_BITS)]
            heads = model.head_map[_bucket(np.concatenate([t[2] for t in batch]), HEAD_BITS)]
            starts, rows, heads = _padded(docs, len(batch), rows, heads)
            pooled, (x, *responses) = _pooled(model._replace(out_bias=out_bias), rows, heads, starts)
            error = (1 / (1 + np.exp(-(pooled @ model.out + out_bias))) - label) / len(batch)
            back = np.outer(error, model.out) * (pooled > 0)
            step("out", model.out, (error @ pooled).astype(np.float32))
            out_bias -= RATE * float(error.sum())
            touched, grads = [], []
            ends = [*starts[1:], len(rows)]
            for i, (width, z) in enumerate(zip(WIDTHS, responses, strict=True)):
                part = back[:, i * FILTERS:(i + 1) * FILTERS]
                best = np.array([z[a:b].argmax(axis=0) + a for a, b in zip(starts, ends, strict=True)])
                change = np.zeros_like(model.filters[i])
                for w in range(width):
                    at = np.where(rows[best] == 0, best, np.minimum(best + w, len(rows) - 1))
                    change[w * SIZE:(w + 1) * SIZE] = np.einsum("dfs,df->sf", x[at], part)
                    touched.append(at.ravel())
                    grads.append((part[:, :, None] * model.filters[i][w * SIZE:(w + 1) * SIZE].T[None]).reshape(-1, SIZE))
                step(f"f{i}", model.filters[i], change)
                step(f"b{i}", model.biases[i], part.sum(axis=0).astype(np.float32))
            at, grad = np.concatenate(touched), np.concatenate(grads).astype(np.float32)
            for name, table, index in (("words", model.words, rows[at]), ("heads", model.heads, heads[at])):
                seen, inverse = np.unique(index, return_inverse=True)
                total = np.zeros((len(seen), SIZE), np.float32)
                np.add.at(total, inverse, grad)
                step(name, table, total[seen > 1], seen[seen > 1])
    return model._replace(out_bias=out_bias)


def _steps(texts: list, order: np.ndarray) -> Iterator[list]:
    """`BATCH` documents at a time, fewer if they are long."""
    batch, held = [], 0
    for i in order:
        batch.append(texts[i])
        held += len(texts[i][1])
        if len(batch) == BATCH or held >= STEP_WORDS:
            yield batch
            batch, held = [], 0
    if batch:
        yield batch


def _best_threshold(logits: np.ndarray, toxic: np.ndarray, count: np.ndarray) -> float:
    """The middle of the gap between two logits at which F1 is largest; each logit stands for `count` documents."""
    order = np.argsort(-logits, kind="stable")
    z, n, y = logits[order], count[order], (count * toxic)[order]
    f1 = 2 * np.cumsum(y) / (np.cumsum(n) + y.sum())
    f1[:-1][z[:-1] == z[1:]] = -1
    k = int(np.argmax(f1))
    return float((z[k] + z[k + 1]) / 2 if k + 1 < len(z) else z[k] - 1)


def _thresholds(logits: np.ndarray, language: np.ndarray, toxic: np.ndarray, count: np.ndarray) -> np.ndarray:
    """One for each language that has ten documents of either label, the common one for the others."""
    both = toxic.any() and not toxic.all()
    got = np.full(len(LANGUAGES), _best_threshold(logits, toxic, count) if both else float(logits.max(initial=0.0)) + 1)
    for k in range(len(LANGUAGES)):
        own = language == k
        if min(count[own & toxic].sum(), count[own & ~toxic].sum()) >= 10:
            got[k] = _best_threshold(logits[own], toxic[own], count[own])
    return got


def held_out(doc_id: Column) -> Column:
    """Whether a row's label is not to be learnt from. A null id counts as held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(True))


def _hash_rows(batches: Iterator[pa.RecordBatch], most_words: float = MOST_WORDS) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        word_bytes: list[bytes] = [b""] * batch.num_rows
        head_bytes, count = list(word_bytes), [0] * batch.num_rows
        for group in words(batch.column("text"), breaks_at_symbols(), HEAD, lower=True):
            edges = np.searchsorted(group.text, np.arange(group.first, group.last + 1))
            for i, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True), group.first):
                count[i] = int(b - a)
                if count[i] <= most_words:
                    # Only the buckets count, so four bytes a word are enough.
                    word_bytes[i] = _bucket(group.hash[a:b], WORD_BITS).astype(np.uint32).tobytes()
                    head_bytes[i] = _bucket(group.head[a:b], HEAD_BITS).astype(np.uint32).tobytes()
        yield pa.RecordBatch.from_arrays(
            [batch.column("toxic"), batch.column("draw"), pa.array(count, pa.int64()),
             pa.array(word_bytes, pa.binary()), pa.array(head_bytes, pa.binary())],
            ["toxic", "draw", "n", "words", "heads"])


def _count_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The documents of one task that have each bucket, by label; of a fixed size, whatever the task reads."""
    counts = [np.zeros((2, 1 << bits), np.int64) for bits in (WORD_BITS, HEAD_BITS)]
    for toxic, own, heads in _rows(batches):
        for kind, (buckets, bits) in enumerate(((own, WORD_BITS), (heads, HEAD_BITS))):
            _seen([buckets], [toxic], bits, counts[kind])
    for kind, both in enumerate(counts):
        there = np.flatnonzero(both.any(axis=0))
        for k in range(0, len(there), 1 << 16):
            at = there[k:k + (1 << 16)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(at), kind, np.int32)), pa.array(at.astype(np.int32)), pa.array(both[0, at]), pa.array(both[1, at])],
                ["kind", "bucket", "clean", "toxic"])


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bool, np.ndarray, np.ndarray]]:
    for batch in batches:
        for toxic, own, heads in zip(*(batch.column(c) for c in ("toxic", "words", "heads")), strict=True):
            yield toxic.as_py(), *(np.frombuffer(x.as_buffer(), np.uint32) for x in (own, heads))


def _tables(model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The weights as rows of `SIZE` numbers: words, heads, and all others in a row."""
    rest = np.concatenate([*(f.ravel() for f in model.filters), *model.biases, model.out, [model.out_bias]])
    return model.words, model.heads, np.pad(rest, (0, -len(rest) % SIZE)).reshape(-1, SIZE)


def _with_rest(model: Model, rest: np.ndarray) -> Model:
    ends = np.cumsum([*(f.size for f in model.filters), *(b.size for b in model.biases), model.out.size])
    parts = [p.astype(np.float32) for p in np.split(rest.ravel(), ends)]
    n = len(WIDTHS)
    filters = [p.reshape(f.shape) for p, f in zip(parts, model.filters, strict=False)]
    return model._replace(filters=filters, biases=parts[n:2 * n], out=parts[2 * n], out_bias=float(parts[-1][0]))


def _trained_change(model: Model, texts: list, shard: int) -> Iterator[pa.RecordBatch]:
    """The rows of the weights that training on one shard has changed, and by how much."""
    own = model._replace(**{k: getattr(model, k).copy() for k in ("words", "heads", "out")},
                         **{k: [a.copy() for a in getattr(model, k)] for k in ("filters", "biases")})
    own = _train(own, texts, np.random.default_rng([7, shard]))
    for kind, (before, after) in enumerate(zip(_tables(model), _tables(own), strict=True)):
        at = np.flatnonzero((before != after).any(axis=1)) if kind < 2 else np.arange(len(before))
        change = np.rint((after[at].astype(np.float64) - before[at]) * UNIT).astype(np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(at), kind, np.int32)), pa.array(at.astype(np.int32)), *(pa.array(np.ascontiguousarray(c)) for c in change.T)],
            ["kind", "row", *(f"d{i}" for i in range(SIZE))])


def _train_shards(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    """Rows come shard by shard; a shard of too many words is trained in parts."""
    texts, held, last = [], 0, None
    for batch in batches:
        for shard, row in zip(batch.column("shard").to_pylist(), _rows([batch]), strict=True):
            if texts and (shard != last or held >= SHARD_WORDS):
                yield from _trained_change(model, texts, last)
                texts, held = [], 0
            texts.append(row)
            held, last = held + len(row[1]), shard
    if texts:
        yield from _trained_change(model, texts, last)


def _judge_rows(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    """The logit of each document in whole steps, its language and label."""
    for batch in batches:
        got = [(*_logit(model, own, heads), toxic) for toxic, own, heads in _rows([batch])]
        steps = np.rint(np.clip([z for z, _, _ in got], -LOGIT_END, LOGIT_END) * LOGIT_STEPS).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [pa.array(steps), pa.array([k for _, k, _ in got], pa.int32()), pa.array([t for _, _, t in got], pa.bool_())],
            ["step", "language", "toxic"])


def hashed_labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Word and head buckets of every labelled document of the folds that may be learnt from, whole, shard by shard, as a stored table.

    Of contradicting labels of one id the larger counts.
    """
    open_fold = F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))
    labelled = labels.where(open_fold & F.col("toxic").isNotNull()).groupBy("doc_id").agg((F.max("toxic") > 0).alias("toxic")).withColumn(
        "draw", F.xxhash64(F.lit(11), "doc_id"))
    # Unlabelled texts are mostly left out before the join by a bitmap of hashed ids, whose size is fixed.
    place = F.xxhash64("doc_id")
    word, bit = F.pmod(place, F.lit(BITMAP_WORDS)), F.shiftrightunsigned(place, 58).cast("int")
    bits = labelled.groupBy(word.alias("_word")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit)).alias("_bits"))
    marked = docs.where(open_fold).select("doc_id", F.col("text").cast("string").alias("text"), word.alias("_word"), bit.alias("_bit")).join(
        F.broadcast(bits), "_word").where(F.getbit("_bits", "_bit") == 1)
    texts = marked.select("doc_id", "text").join(labelled.hint("merge"), "doc_id")
    shards = max(1, -(-docs.where(open_fold).select("doc_id").join(labelled, "doc_id").count() // SHARD_DOCS))
    hashed = texts.select("toxic", "draw", "text").mapInArrow(
        partial(_hash_rows, most_words=float("inf")), "toxic boolean, draw long, n long, words binary, heads binary")
    sharded = hashed.withColumn("shard", F.pmod("draw", F.lit(shards)).cast("int"))
    return stored(sharded.repartition(shards, "shard").sortWithinPartitions("shard", "draw", F.xxhash64("words")), "labelled")


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Fits on all labelled documents of the folds that may be learnt from, each of them whole.

    The documents that have each bucket are counted over the cluster. Shards of `SHARD_DOCS` documents are trained from the same start, side by
    side, and what they change is averaged: each row of the embeddings over the shards that have changed it. A fourth of the documents is kept
    back; their logits are counted in fine steps for the thresholds. The driver holds the model, whose size the buckets bound, and counts by
    bucket and step, but no documents.
    """
    rows = hashed_labelled(docs, labels)
    tuned = F.lit(rows.count() >= LEAST_TUNED) & (F.pmod(F.xxhash64(F.lit(5), "draw"), F.lit(TUNING_SHARE)) == 0)
    fitting, kept = rows.where(~tuned), rows.where(tuned)
    by_label = {r["toxic"]: r["count"] for r in fitting.groupBy("toxic").count().collect()}
    number = by_label.get(False, 0), by_label.get(True, 0)
    counts = fitting.select("toxic", "words", "heads").mapInArrow(_count_rows, "kind int, bucket int, clean long, toxic long")
    enough = counts.groupBy("kind", "bucket").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).where(
        F.col("clean") + F.col("toxic") >= LEAST_DOCS).toArrow()
    seen = [np.zeros((2, 1 << bits), np.int64) for bits in (WORD_BITS, HEAD_BITS)]
    kind, bucket, clean, toxic = (enough[c].to_numpy() for c in ("kind", "bucket", "clean", "toxic"))
    for k, both in enumerate(seen):
        both[:, bucket[kind == k]] = clean[kind == k], toxic[kind == k]
    model = _untrained(*seen, number, np.random.default_rng(7))
    if not min(number):
        return model
    model = _averaged(model, fitting)
    if kept.isEmpty():
        kept = fitting
    sent = docs.sparkSession.sparkContext.broadcast(model)
    judged = kept.select("toxic", "words", "heads").mapInArrow(
        lambda batches: _judge_rows(batches, sent.value), "step int, language int, toxic boolean")
    got = judged.groupBy("step", "language", "toxic").count().orderBy("step", "language", "toxic").toArrow()
    sent.destroy()
    step, language, toxic, count = (got[c].to_numpy() for c in ("step", "language", "toxic", "count"))
    return model._replace(thresholds=_thresholds(step / LOGIT_STEPS, language, toxic.astype(bool), count))


def _averaged(model: Model, fitting: DataFrame) -> Model:
    """The model after training on every shard."""
    sent = fitting.sparkSession.sparkContext.broadcast(model)
    parts = [f"d{i}" for i in range(SIZE)]
    changes = fitting.select("shard", "toxic", "words", "heads").mapInArrow(
        lambda batches: _train_shards(batches, sent.value), f"kind int, row int, {', '.join(f'{p} long' for p in parts)}")
    got = changes.groupBy("kind", "row").agg(F.count("*").alias("n"), *(F.sum(p).alias(p) for p in parts)).toArrow()
    sent.destroy()
    kind, row, n = (got[c].to_numpy() for c in ("kind", "row", "n"))
    change = np.stack([got[p].to_numpy() for p in parts], axis=1) / UNIT / n[:, None]
    tables = [t.astype(np.float64) for t in _tables(model)]
    for k, table in enumerate(tables):
        table[row[kind == k]] += change[kind == k]
    return _with_rest(model._replace(words=tables[0].astype(np.float32), heads=tables[1].astype(np.float32)), tables[2])


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """Every row with its score and predicted (1 from `THRESHOLD` on); null and empty texts are scored as texts without words.

    Columns named score or predicted are replaced, others pass unchanged. The model is of a fixed size and is broadcast.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    columns = [c for c in docs.columns if c not in ("score", "predicted")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = score_column(sent.value, batch.column("text").cast(pa.string()))
            arrays = [*batch.columns, pa.array(scores), pa.array((scores >= THRESHOLD).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(arrays, [*batch.schema.names, "score", "predicted"])

    kept = docs.select(*[F.col(f"`{c}`") for c in columns])
    schema = StructType([*kept.schema.fields, StructField("score", DoubleType()), StructField("predicted", IntegerType())])
    return kept.mapInArrow(run, schema)


def without_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of `docs` whose text is not called toxic, with all their columns, whatever their names. Null and empty texts are scored like others."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(score_column(sent.value, batch.column("text").cast(pa.string())) < THRESHOLD))

    return docs.mapInArrow(run, docs.schema)


def toxicity_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every row.

    Null and empty texts are scored as texts without words; texts are read whole, in pieces; repeated rows get equal scores, whatever stands beside
    them in a batch. A null doc_id counts as held out. An empty table gives no rows; without labels of both kinds no text is
    called toxic; other columns are not looked at.
    """
    scored = score_documents(docs.select("doc_id", F.col("text").cast("string").alias("text")), train(docs, labels))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
