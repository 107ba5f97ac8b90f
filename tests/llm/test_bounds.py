"""Bounds of time, size and place of the corpus operators, and plain versions of the parts that SQL cannot express."""

import itertools
import math
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest

from plyforge.llm import chat, line_dedup, metric_search, pii, sharding, toxicity, warc
from plyforge.llm.texts import breaks_at_symbols, word_hashes
from tests.llm.nasty import SCHEMA

SF = "/root/testdata/sf0.01"


def test_a_long_contact_list_takes_linear_time():
    text = "\n".join(f"name{i}@example.org tel (030) 555-{i % 10000:04d} call" for i in range(50_000))
    start = time.perf_counter()
    spans = pii.spans_of(text)
    assert len(spans) >= 50_000 and time.perf_counter() - start < 8


def test_overlaps_as_all_pairs_find_them():
    text = " ".join(f"IBAN DE89 3704 0044 0532 0130 00 card 4111 1111 1111 1{k}11 tel +49 30 1234567{k} 10.0.0.{k} (030) 555-12{k:02d}" for k in range(40))
    spans = pii.spans_of(text)
    added = [s for s in spans if s.kind in pii.ADDED_KINDS]
    assert added and not any(a.start < b.end and b.start < a.end for a in added for b in spans if a is not b)
    missing = [x for x in pii._added(text) if x not in {(s.kind, s.start, s.end) for s in added}]
    for kind, start, end in missing:
        assert pii._score(text, kind, start, end) < pii.LEAST_SCORE or any(start < s.end and s.start < end for s in spans)


def test_components_that_no_long_can_hold(spark):
    rows = [(1, [1.0, 2.0]), (2, [1e17, 1.0]), (3, [1e308, 1e308]), (4, [-7e6, 1.0]), (5, [2.0, 2.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [tuple(r) for r in metric_search.top_k(vectors, vectors.where("vec_id in (1, 2)")).orderBy("rank").collect()]
    assert got == [(1, 1, 5, 6 * 65536), (1, 2, 4, (-7_000_000 + 2) * 65536)]


def test_boilerplate_by_length_of_line(spark):
    """Of 1,000 pages of a site: a short line on 9 stays, on 11 goes; a long one on 5 goes, on 4 stays; single lines stay."""
    long_, rare = ("a passage of many words " * 12).strip(), ("another passage of many words " * 12).strip()
    rows = []
    for i in range(1000):
        lines = [f"own line {i}"]
        lines += ["short and rare"] * (i < 9) + ["short and frequent"] * (i < 11) + [long_] * (i < 5) + [rare] * (i < 4)
        rows.append((i, "\n".join(lines), "en", "site", 0))
    got = {r["doc_id"]: r["text"].split("\n") for r in line_dedup.drop_boilerplate(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got[0] == ["own line 0", "short and rare", rare] and got[999] == ["own line 999"]


@pytest.mark.parametrize("base", ["", "file:"])
def test_archives_go_where_tables_go(spark, tmp_path, base):
    address = warc.shared_address(spark, f"{base}{tmp_path}/x")
    assert address == f"file://{tmp_path}/x"
    hadoop = spark._jsc.hadoopConfiguration()
    default = hadoop.get("fs.defaultFS")
    hadoop.set("fs.defaultFS", "viewfs://store")
    hadoop.set("fs.viewfs.mounttable.store.link./shared", f"file://{tmp_path}")
    try:
        assert warc.shared_address(spark, "/shared/x") == "viewfs://store/shared/x"
    finally:
        hadoop.set("fs.defaultFS", default)


def test_unknown_stores_are_refused(spark):
    hadoop = spark._jsc.hadoopConfiguration()
    hadoop.set("fs.odd.impl", "org.apache.hadoop.fs.RawLocalFileSystem")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        warc.shared_address(_Odd(), "odd://x/y")


class _Odd:
    """As much of a session as `shared_address` asks for, on a store that pyarrow does not know."""

    class _jsc:
        @staticmethod
        def hadoopConfiguration():
            return None

    class _jvm:
        class org:
            class apache:
                class hadoop:
                    class fs:
                        class Path:
                            def __init__(self, path):
                                self.path = path

                            def getFileSystem(self, _):
                                return self

                            def makeQualified(self, _):
                                return self

                            def toString(self):
                                return self.path


def test_scores_by_a_plain_forward_pass():
    """Word by word and filter by filter, in plain loops."""
    rng = np.random.default_rng(3)
    vocabulary = [f"word{i}" for i in range(60)] + ["the", "der", "les", "los"]
    texts = [" ".join(rng.choice(vocabulary, rng.integers(0, 40))) + (" vile" * (i % 3 == 0)) for i in range(120)]
    hashed = [word_hashes(t, breaks_at_symbols(), toxicity.HEAD) for t in texts]
    model = toxicity.fit([(i % 3 == 0, h.hash, h.head) for i, h in enumerate(hashed)])
    want = []
    for h in hashed:
        rows = [int(model.word_map[int(x) >> (64 - toxicity.WORD_BITS)]) for x in h.hash]
        heads = [int(model.head_map[int(x) >> (64 - toxicity.HEAD_BITS)]) for x in h.head]
        vectors = [[float(a) + float(b) for a, b in zip(model.words[r], model.heads[k])] for r, k in zip(rows, heads)]
        nothing = [0.0] * toxicity.SIZE
        logit = float(model.out_bias)
        for i, width in enumerate(toxicity.WIDTHS):
            for f in range(toxicity.FILTERS):
                best = 0.0
                # A filter also looks at windows that begin in the two padding rows.
                for at in range(len(vectors) + 2):
                    window = itertools.chain.from_iterable((vectors[at + k] if at + k < len(vectors) else nothing) for k in range(width))
                    best = max(best, sum(x * float(w) for x, w in zip(window, model.filters[i][:, f])) + float(model.biases[i][f]))
                logit += best * float(model.out[i * toxicity.FILTERS + f])
        spoken = [sum(int(model.language[r]) == k for r in rows) for k in range(4)]
        language = spoken.index(max(spoken)) if max(spoken) else 4
        z = logit - float(model.thresholds[language]) + math.log(toxicity.THRESHOLD / (1 - toxicity.THRESHOLD))
        want.append(1 / (1 + math.exp(-z)))
    assert np.allclose(toxicity.score_column(model, pa.array(texts)), want, atol=1e-5)


def test_best_states_among_all_paths():
    """Every path of states through short transcripts, scored on its own."""
    rng = np.random.default_rng(5)
    model = chat.Model(rng.random(chat.STATES), rng.random((chat.STATES, chat.STATES)), rng.random((chat.STATES, chat.SYMBOLS)))
    for length in (1, 2, 4):
        for _ in range(4):
            symbols = rng.integers(0, chat.SYMBOLS, length)

            def score(path):
                total = model.first[path[0]] + model.shown[path[0], symbols[0]]
                for t in range(1, length):
                    total += model.step[path[t - 1], path[t]] + model.shown[path[t], symbols[t]]
                return total

            best = max(itertools.product(range(chat.STATES), repeat=length), key=score)
            assert tuple(chat.decode(model, symbols, None, None)) == best


def test_sizes_and_sums_of_sharded_documents(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = sharding.shard_documents(spark.read.parquet(f"{SF}/documents.parquet")).collect()
    assert {r["doc_id"] for r in rows} == docs.keys()
    slots = {}
    for r in rows:
        data = (docs[r["doc_id"]] or "").encode()
        assert r["size"] == len(data) + 1 and r["text_crc32"] == zlib.crc32(data) and r["law"] == "key"
        assert 0 <= r["shard"] < 16 and r["grown_shard"] in (r["shard"], 16)
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
