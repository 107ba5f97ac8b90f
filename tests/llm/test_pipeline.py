"""The stages of the pipeline on their own inputs, against plain versions."""

import random

import pytest

import corpus_pipeline
from plyforge.llm import line_dedup
from plyforge.sources.paths import stored
from tests.llm import plain
from tests.llm.nasty import SCHEMA

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def passed(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    tables = [docs]
    for name, stage in corpus_pipeline.STAGES:
        tables.append(stored(stage(spark, tables[-1], SF), name))
    return [{r["doc_id"]: r for r in t.collect()} if "text" in t.columns else t.collect() for t in tables]


def test_toxic_documents_go(spark, passed):
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    gone = passed[0].keys() - passed[1].keys()
    assert gone and all(labels.get(i, 1) == 1 for i in gone)


def share(line):
    return line_dedup.LONG_RATIO if len(line) >= line_dedup.LONG else line_dedup.RATIO


def test_lines(passed):
    before, after = passed[1], passed[2]
    assert before.keys() == after.keys()
    least = line_dedup.LEAST_PAGES
    sources = {}
    for r in before.values():
        sources.setdefault(r["source"], []).append({x.strip(" ") for x in r["text"].split("\n")})
    for i, r in before.items():
        own = sources[r["source"]]
        kept = [x for x in r["text"].split("\n") if not x.strip(" ") or not (
            (n := sum(x.strip(" ") in p for p in own)) >= least and n > share(x.strip(" ")) * len(own))]
        assert after[i]["text"] == "\n".join(kept) and after[i]["n_chars"] == len(after[i]["text"])


def test_one_of_each_component(passed):
    want = plain.components({i: plain.shingles(r["text"], corpus_pipeline.NEAR_WORDS) for i, r in passed[2].items()}, corpus_pipeline.NEAR_PERCENT)
    assert passed[3].keys() == {i for i, c in want.items() if i == c}


def test_near_copies_of_five_words(spark):
    """The stage's own thresholds: copies with changed words, around a similarity of 0.8, and short texts with words put behind them."""
    rng = random.Random(9)
    rows = []
    for family in range(12):
        base = [f"f{family}w{i}" for i in range(rng.randint(20, 160))]
        for _ in range(8):
            words = list(base)
            for _ in range(rng.randint(0, 3)):
                words[rng.randrange(len(words))] = f"x{rng.randrange(10 ** 6)}"
            rows.append(" ".join(words + [f"e{rng.randrange(10 ** 6)}" for _ in range(rng.randint(0, 4))]))
    frame = spark.createDataFrame([(i, t, "en", "a", len(t)) for i, t in enumerate(rows)], SCHEMA)
    want = plain.components({i: plain.shingles(t, 5) for i, t in enumerate(rows)}, 80)
    strict = plain.components({i: plain.shingles(t) for i, t in enumerate(rows)})
    assert len(set(want.values())) < len(set(strict.values()))
    got = [r["doc_id"] for r in corpus_pipeline.drop_near_copies(spark, frame, SF).collect()]
    assert sorted(got) == sorted(set(want.values()))


def test_leaks(spark, passed):
    items = [r["text"].lower() for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    hit = {i for i, r in passed[3].items() if any(x in r["text"].lower() for x in items)}
    assert passed[4].keys() == passed[3].keys() - hit


def test_packed(spark, passed):
    assert {r["doc_id"] for r in passed[5]} == passed[4].keys()
    whole = corpus_pipeline.run(spark, SF).select("doc_id", "start", "length", "ids_crc32").collect()
    assert sorted(map(tuple, whole)) == sorted((r["doc_id"], r["start"], r["length"], r["ids_crc32"]) for r in passed[5])
