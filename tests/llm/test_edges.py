"""Every operator and stage on nulls, empty and very long texts, repeated rows, empty tables and clashing column names."""

import pytest

import corpus_pipeline
from plyforge.llm import chat, decontamination, line_dedup, metric_search, ngram_join, packing, pii, sharding, toxicity, warc
from plyforge.llm.queries import tokenizer_path
from tests.llm.nasty import CLASHING, ROWS, documents

LABELS = [(1, 1, 1), (6, 1, 0), (8, None, None), (9, 0, 0), (None, 1, 1), (10, 1, 1), (1, 1, 0)]
ITEMS = [(1, "Is this asked? Yes it is."), (2, None), (3, ""), (None, "w1x1 w2x2 w3x3 w4x4 w5x5. w6x6 w7x7."), (1, "Is this asked? Yes it is.")]


def labels(spark, rows=LABELS):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def benchmark(spark, rows=ITEMS):
    return spark.createDataFrame(rows, "item_id long, text string")


OPERATORS = {
    "toxicity": lambda s, d: toxicity.toxicity_scores(d, labels(s)),
    "pii": lambda s, d: pii.find_pii(d),
    "sharding": lambda s, d: sharding.shard_documents(d),
    "line_dedup": lambda s, d: line_dedup.drop_boilerplate(d),
    "ngram_join": lambda s, d: ngram_join.similar_documents(d),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_one_row_for_each_row(spark, name):
    got = OPERATORS[name](spark, documents(spark)).collect()
    assert len(got) == len(ROWS)
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(r[0]) for r in ROWS)


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(spark, name):
    assert OPERATORS[name](spark, documents(spark, [])).collect() == []


def test_packing(spark):
    got = packing.pack_documents(documents(spark), tokenizer_path()).collect()
    assert sum(r["doc_tokens"] == 1 and r["doc_id"] in (3, 4) for r in got) == 2
    assert {r["doc_id"] for r in got} == {r[0] for r in ROWS}
    assert packing.pack_documents(documents(spark, []), tokenizer_path()).collect() == []


def test_decontamination(spark):
    got = decontamination.contaminated_pairs(documents(spark), benchmark(spark)).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} <= {(6, None)}
    kept = decontamination.without_leaks(documents(spark), benchmark(spark))
    assert len(kept.columns) == 5 + len(CLASHING) and kept.count() >= len(ROWS) - 1
    assert decontamination.contaminated_pairs(documents(spark, []), benchmark(spark)).collect() == []
    assert decontamination.without_leaks(documents(spark), benchmark(spark, [])).count() == len(ROWS)


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages(spark, tmp_path, name):
    labels(spark).write.parquet(str(tmp_path / "labels.parquet"))
    benchmark(spark).write.parquet(str(tmp_path / "benchmark.parquet"))
    stage = dict(corpus_pipeline.STAGES)[name]
    docs = documents(spark)
    got = stage(spark, docs, str(tmp_path))
    got.collect()
    if name != "packing":
        assert got.columns == docs.columns
        clashing = {c: f"own {c}" for c in CLASHING if not (name == "line_dedup" and c == "lines_total")}
        assert all(r[c] == v for r in got.collect() for c, v in clashing.items())
    assert stage(spark, documents(spark, []), str(tmp_path)).collect() == []


def test_near_copies_keep_one_row(spark):
    kept = ngram_join.one_of_each(documents(spark)).select("doc_id").collect()
    # Rows without words stay; 1 stands for its copies, 9 for 10, and the null id keeps its own text.
    assert sorted(str(r[0]) for r in kept) == sorted(map(str, [1, 3, 4, 5, None, None, 6, 7, 8, 9]))


def test_warc(spark):
    rows = [(1, "http://a.example/x", "same"), (2, "http://a.example/x", "same"), (2, "http://a.example/x", "same"), (3, None, None), (4, "", ""),
            (None, "not a url\r\nX-Page: 9", "z"), (5, "http://[bad", "y" * 200_000), (6, "HTTP://Example.COM:80/A?b#c", "line\r\n\r\nmore\r\n")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("payload", warc.F.lit("own"))
    got = {}
    for r in warc.round_trip(pages).collect():
        got.setdefault(r["page_id"], []).append((r["payload_bytes"], r["record_type"], r["refers_to"]))
    assert got == {1: [(4, "revisit", 2)], 2: [(4, "response", None)] * 2, 3: [(0, "revisit", 4)], 4: [(0, "response", None)],
                   None: [(1, "response", None)], 5: [(200_000, "response", None)], 6: [(14, "response", None)]}
    assert warc.round_trip(pages.limit(0)).collect() == []


def test_search(spark):
    rows = [(1, [1.0, 2.0], 0), (1, [1.0, 2.0], 0), (2, None, 0), (3, [1.0, None], 0), (4, [float("nan"), 1.0], 0), (5, [], 0), (None, [3.0, 3.0], 0),
            (6, [1.0, 2.0, 3.0], 0), (7, [2.0, 2.0], 0), (8, [2.0, 2.0], 0), (9, [-1.0, 0.5], 0)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>, vec int")
    got = [tuple(r) for r in metric_search.top_k(vectors, vectors.where("vec_id in (1, 6, 7)")).orderBy("query_id", "rank").collect()]
    assert got == [(1, 1, 7, 393216), (1, 2, 8, 393216), (1, 3, 9, 0), (7, 1, 8, 524288), (7, 2, 1, 393216), (7, 3, 9, -65536)]
    assert metric_search.top_k(vectors.limit(0), vectors.limit(0)).collect() == []


def test_chat(spark):
    rows = [(1, 0, "user", "hi\nthere"), (1, 1, "assistant", None), (1, 1, "assistant", None), (1, 2, None, "who?"), (2, 0, "other", "text"), (None, 0, "user", ""),
            (3, None, "user", "no turn"), (3, 0, "user", "w " * 100_000)]
    talk = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("line", chat.F.lit("own"))
    got = chat.canonical_turns(talk).collect()
    assert {r["conv_id"] for r in got} == {1, 2, 3, None}
    assert chat.canonical_turns(talk.limit(0)).collect() == []
