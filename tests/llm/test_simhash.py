"""SimHash fingerprints and their components against slow versions."""

import itertools
import random

import numpy as np
import pytest
import xxhash

from plyforge.llm import simhash
from plyforge.llm.queries import QUERIES
from tests.llm import plain
from tests.llm.nasty import ROWS, documents

SF = "/root/testdata/sf0.01"


def plain_print(text):
    words = plain.WORD.findall((text or "").translate(plain.LOWER))
    runs = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints):
    """{print: a name of its component}, comparing all pairs."""
    keys = sorted(set(prints))
    label = {k: k for k in keys}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, b in itertools.combinations(keys, 2):
        if (a ^ b).bit_count() <= 3:
            x, y = root(a), root(b)
            label[max(x, y)] = min(x, y)
    return {k: root(k) for k in keys}


def want_rows(rows):
    prints = [(i, plain_print(t)) for i, t in rows]
    parts = plain_components(p for _, p in prints)
    least = {}
    for i, p in prints:
        if i is not None:
            least[parts[p]] = min(i, least.get(parts[p], i))
    return sorted(((i, f"{p:016x}", least.get(parts[p])) for i, p in prints), key=repr)


def got_rows(frame):
    return sorted((tuple(r) for r in frame.select("doc_id", "fingerprint", "component_id").collect()), key=repr)


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert got_rows(QUERIES["op11_simhash"](spark, SF)) == want_rows(map(tuple, docs))


def test_edges(spark):
    assert got_rows(simhash.near_documents(documents(spark))) == want_rows((r[0], r[1]) for r in ROWS)
    assert simhash.near_documents(documents(spark, [])).collect() == []


def test_long_texts_in_pieces(monkeypatch):
    text = " ".join(f"Wort{i}\tÄ{i % 7}" for i in range(500)).encode()
    whole = simhash.fingerprint(memoryview(text))
    assert whole == plain_print(text.decode())
    for piece in (3, 10, 64, 4096):
        monkeypatch.setattr(simhash, "PIECE", piece)
        assert simhash.fingerprint(memoryview(text)) == whole


@pytest.mark.parametrize("radius", [1, 2, 3])
def test_masks_cover_every_pair(radius):
    masks = simhash.covering_masks(64, radius)
    assert len(masks) == 2 ** (radius + 1) - 1
    rng = random.Random(radius)
    for flipped in itertools.chain(itertools.combinations(range(0, 64, 3), radius), (rng.sample(range(64), radius) for _ in range(2000))):
        difference = sum(1 << i for i in flipped)
        tables = [m for m in masks if not m & difference]
        assert tables
        # A table is split into finer ones that still cover the pair.
        assert all(any(not part & difference for part in simhash.split_mask(m, radius)) for m in tables)


@pytest.mark.parametrize("bucket", [64, 200, 2048])
def test_buckets_of_any_size(spark, bucket):
    """A dense cloud of prints around a few centres, so that small buckets are split several times."""
    rng = random.Random(4)
    prints = {0, 2 ** 64 - 1}
    for _ in range(3):
        centre = rng.getrandbits(64)
        for _ in range(150):
            x = centre
            for _ in range(rng.randint(0, 9)):
                x ^= 1 << rng.randrange(0, 64, 4)
            prints.add(x)
    frame = spark.createDataFrame([(simhash._signed(p),) for p in prints], "print long")
    want = plain_components(prints)
    label = {p: p for p in prints}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for r in simhash.linked_prints(frame, bucket=bucket).collect():
        a, b = r["a"] % 2 ** 64, r["b"] % 2 ** 64
        assert (a ^ b).bit_count() <= 3
        x, y = root(a), root(b)
        label[max(x, y)] = min(x, y)
    assert {p: root(p) for p in prints} == want


def test_too_small_buckets(spark):
    with pytest.raises(ValueError):
        simhash.linked_prints(spark.range(1).select(simhash.F.col("id").alias("print")), bucket=4)


def test_spanning_links_reach_all():
    chain = np.array([(1 << i) - 1 for i in range(0, 60, 3)], np.uint64)
    a, b = simhash.spanning_links(chain)
    assert len(a) == len(b) == len(chain) - 1
