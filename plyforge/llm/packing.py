"""Sum-of-squares packing of tokenised documents into fixed windows."""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plyforge.sources.paths import stored

WINDOW = 1024
END_ID = 0
ROWS_PER_PACKER = 50_000
STRETCH = 1_000_000
CACHED_CHARS = 32_000_000

PIECES = "doc_id {id}, start long, length long, ids_crc32 long, doc_tokens long"
PACKED = PIECES + ", sequence_id long, offset long"

#: A blank inside a run of white space, at which a text must not be cut; control characters that two libraries class
#: differently; and the text of the special token.
_WHOLE = re.compile(r"\s (?:\s|\Z)|[\x1c-\x1f]|<\|endoftext\|>")
#: Words without white space whose letters every Unicode table classes alike.
_PLAIN = re.compile(r"[!-~\xa1-\u024f]+").fullmatch
#: How the vocabulary splits a text into pieces. A fixed value.
_PIECES = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_signs() -> dict[str, int]:
    """The byte that each sign of a byte-level vocabulary stands for: printable Latin-1 signs for themselves, others moved up."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    moved = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(moved)}


class Lexicon(dict):
    """Token ids of words by number, encoded once and in batches.

    A key is a word after a blank, (text,) for a text as it stands, or (text, "whole") for one with runs of white space or the
    special token. Cutting before a single blank never changes the ids, because this vocabulary's words begin with their blank.
    Plain words of Latin letters are encoded many at a time as one line with the same merges by tiktoken, which is about
    eight times as fast as one call of tokenizers for each; everything else goes to tokenizers.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        signs, special = _byte_signs(), self.tokenizer.get_added_tokens_decoder()
        ranks = {bytes(signs[c] for c in k): v for k, v in self.tokenizer.get_vocab().items() if v not in special}
        self.lines = tiktoken.Encoding("lines", pat_str=_PIECES, mergeable_ranks=ranks, special_tokens={})
        self.bytes_of = np.zeros(max(ranks.values()) + 1, np.int64)
        self.bytes_of[list(ranks.values())] = [len(k) for k in ranks]
        self.reset()

    def reset(self) -> None:
        self.clear()
        self.words: list[str] = []
        self.word_numbers: list[int] = []
        self.others: list[str] = []
        self.other_numbers: list[int] = []
        self.chars = 0
        self.flat, self.used = np.zeros(1 << 16, np.uint32), 1
        self.starts, self.sizes = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)
        self.flat[0], self.sizes[0] = END_ID, 1
        self[("", "end")] = 0

    def __missing__(self, key) -> int:
        self[key] = number = len(self)
        if isinstance(key, str) and _PLAIN(key):
            self.words.append(" " + key)
            self.word_numbers.append(number)
            self.chars += len(key) + 64
        else:
            text = key[0] if isinstance(key, tuple) else " " + key
            self.others.append(text)
            self.other_numbers.append(number)
            self.chars += len(text) + 64
        return number

    def _keep(self, numbers: list[int], ids: np.ndarray, sizes: np.ndarray) -> None:
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while len(self) > len(self.sizes):
            self.sizes, self.starts = (np.concatenate([x, np.zeros_like(x)]) for x in (self.sizes, self.starts))
        self.flat[self.used:self.used + len(ids)] = ids
        self.sizes[numbers], self.starts[numbers] = sizes, self.used + np.cumsum(sizes) - sizes
        self.used += len(ids)

    def _encode(self) -> None:
        if self.words:
            ids = np.array(self.lines.encode_ordinary("".join(self.words)), np.int64)
            # No token reaches over a blank, so words end where the tokens' bytes add up.
            ends = np.searchsorted(np.cumsum(self.bytes_of[ids]), np.cumsum([len(w.encode()) for w in self.words])) + 1
            self._keep(self.word_numbers, ids, np.diff(ends, prepend=0))
        for k in range(0, len(self.others), 4096):
            got = [e.ids for e in self.tokenizer.encode_batch_fast(self.others[k:k + 4096], add_special_tokens=False)]
            self._keep(self.other_numbers[k:k + 4096], np.concatenate([np.asarray(x, np.uint32) for x in got]),
                       np.fromiter(map(len, got), np.int64, len(got)))
        for waiting in (self.words, self.word_numbers, self.others, self.other_numbers):
            waiting.clear()

    def ids(self, keys: list) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the keys one after another, and the number of each key's ids."""
        number = np.fromiter(map(self.__getitem__, keys), np.int64, len(keys))
        if self.words or self.others:
            self._encode()
        sizes = self.sizes[number]
        ends = np.cumsum(sizes)
        ids = self.flat[np.repeat(self.starts[number] - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)]
        if self.chars > CACHED_CHARS:
            self.reset()
        return ids, sizes


def stretches(text: str) -> Iterator[str]:
    """The text in parts of about a million characters, cut before single blanks between words."""
    start = 0
    while len(text) - start > STRETCH:
        cut = text.find(" ", start + STRETCH)
        while cut > 0 and (text[cut - 1].isspace() or text[cut + 1:cut + 2].isspace() or cut + 1 == len(text)):
            cut = text.find(" ", cut + 1)
        if cut < 0:
            break
        yield text[start:cut]
        start = cut
    yield text[start:]


def _keys(part: str) -> list:
    if _WHOLE.search(part):
        return [(part, "whole")]
    first, *rest = part.split(" ")
    return [(first,), *rest]


def _encoded(texts: list[str], lexicon: Lexicon) -> Iterator[np.ndarray]:
    """The ids of each text, closed by the end id; many short texts are looked up together."""
    keys, ends, chars = [], [], 0

    def flush() -> Iterator[np.ndarray]:
        if ends:
            ids, sizes = lexicon.ids(keys)
            total = np.concatenate([[0], np.cumsum(sizes)])[[0, *ends]]
            yield from (ids[a:b] for a, b in zip(total[:-1], total[1:], strict=True))

    for text in texts:
        if len(text) > STRETCH:
            yield from flush()
            keys, ends, chars = [], [], 0
            parts = [lexicon.ids(_keys(p))[0] for p in stretches(text) if p]
            yield np.concatenate([*parts, np.array([END_ID], np.uint32)])
            continue
        keys += [*(_keys(text) if text else ()), ("", "end")]
        ends.append(len(keys))
        chars += len(text)
        if chars > STRETCH:
            yield from flush()
            keys, ends, chars = [], [], 0
    yield from flush()


def token_pieces(docs: DataFrame, tokenizer: str, window: int = WINDOW) -> DataFrame:
    """Full windows of each document, and its rest in one or two pieces of at most half a window, for which the packing
    wastes little; ids are checksummed and not kept.

    A null or empty text is the end id alone. doc_id may be null or repeated; each row is a document of its own.
    """
    kind = docs.schema["doc_id"].dataType

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(tokenizer)
        for batch in batches:
            row, start, length, crc, total = [], [], [], [], []
            texts = (x or "" for x in batch.column(1).to_pylist())
            for i, ids in enumerate(_encoded(texts, lexicon)):
                raw = memoryview(np.ascontiguousarray(ids, "<u4")).cast("B")
                whole = len(ids) // window * window
                cuts = [*range(0, whole, window), *range(whole, len(ids), window // 2), len(ids)]
                for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                    row.append(i)
                    start.append(a)
                    length.append(b - a)
                    crc.append(zlib.crc32(raw[4 * a:4 * b]))
                    total.append(len(ids))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row, pa.int64())), *(pa.array(x, pa.int64()) for x in (start, length, crc, total))],
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(pieces, PIECES.format(id=kind.simpleString()))


class Packer:
    """Online sum-of-squares packing: `level[h]` counts the open windows filled up to h."""

    def __init__(self, window: int):
        self.window = window
        self.level = np.zeros(window + 1, np.float64)
        self.level[window] = -0.5  # a full window is open no more: it adds nothing to the sum
        self.open: list[list[int]] = [[] for _ in range(window)]
        self.made = 0

    def place(self, size: int) -> tuple[int, int]:
        """Window and offset for a piece: the choice after which the sum of squared level counts is least.

        Moving a window from h to h + size changes the sum by 2 (level[h + size] - level[h]) + 2, a new one by
        2 level[size] + 1. Ties go to the fullest window.
        """
        level, room = self.level, self.window - size
        best, at = 2 * level[size] + 1, 0
        if room > 0:
            change = level[1 + size:] - level[1:room + 1]
            change[level[1:room + 1] <= 0] = np.inf
            back = int(np.argmin(change[::-1]))
            if (found := 2 * change[room - 1 - back] + 2) <= best:
                best, at = found, room - back
        if at:
            level[at] -= 1
            number = self.open[at].pop()
        else:
            number, self.made = self.made, self.made + 1
        if at + size < self.window:
            level[at + size] += 1
            self.open[at + size].append(number)
        return number, at


def pack_pieces(pieces: DataFrame, window: int = WINDOW, rows_per_packer: int = ROWS_PER_PACKER) -> DataFrame:
    """Adds sequence_id and offset. Full pieces are sequences by themselves; shorter ones go through packers.

    Each packer takes an even hash share of the rows in a fixed order, and its state is one level array and the open
    windows. Sequence ids are unique, not gapless; offsets within a sequence are gapless.
    """
    pieces = stored(pieces, "pieces")
    short = pieces.where(F.col("length") < window)
    packers = max(1, -(-short.count() // rows_per_packer))
    salt = F.xxhash64("ids_crc32", "doc_tokens", "start", "doc_id")
    dealt = short.withColumn("_salt", salt).repartition(packers, "_salt", "doc_id").sortWithinPartitions(
        "_salt", "doc_id").withColumn("_part", F.spark_partition_id().cast("long"))

    names = [*pieces.columns, "sequence_id", "offset"]

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(window)
        for batch in batches:
            places = [packer.place(int(n)) for n in batch.column("length").to_numpy()]
            part = batch.column("_part").to_numpy()
            number = np.array([p[0] for p in places], np.int64)
            arrays = [batch.column(i) for i in range(5)]
            arrays += [pa.array((part << 34 | number) * 2 + 1), pa.array([p[1] for p in places], pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names)

    schema = PACKED.format(id=pieces.schema["doc_id"].dataType.simpleString())
    full = pieces.where(F.col("length") == window).select(
        "*", (F.monotonically_increasing_id() * 2).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return full.unionByName(dealt.mapInArrow(packed, schema))


def pack_documents(docs: DataFrame, tokenizer: str, window: int = WINDOW) -> DataFrame:
    """All documents as pieces of packed sequences of at most `window` tokens."""
    return pack_pieces(token_pieces(docs, tokenizer, window), window)
