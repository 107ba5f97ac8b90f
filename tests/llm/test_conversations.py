"""Conversation repair and prefix trie against slow versions, whatever the size of chunks, partitions and fan."""

import random

import pytest
from pyspark.sql import functions as F

from plyforge.llm import repair, trie
from plyforge.llm.queries import QUERIES
from tests.llm import plain_conversations as plain

SF = "/root/testdata/sf0.01"
SCHEMA = "conv_id long, turn long, role string, text string"
TALK = ["conv_id", "turn", "role", "text"]


def rows_of(df):
    return [tuple(r) for r in df.select(*TALK).collect()]


def repaired(frame):
    return {r["conv_id"]: tuple(r[c] for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"))
            for r in frame.collect()}


def nodes(frame):
    return sorted(map(tuple, frame.select(*trie.RESULT).collect()), key=repr)


def untidy(seed=1, conversations=25):
    """Conversations of one to 200 rows with every kind of role and text, some rows more than once."""
    rng = random.Random(seed)
    out = []
    for c in [None, -7, *range(conversations)]:
        for _ in range(rng.choice([1, 3, 10, 60, 200])):
            text = rng.choice([None, "", "  \n", "a.", "b", "c!", "d. \t", "é?", f"{rng.random()}", f"{rng.random()}."])
            out.append((c, rng.choice([None, *range(120)]), rng.choice(["user", "assistant", "system", "user", "assistant", None, "", "tool", "s"]), text))
    return out + out[::9]


@pytest.mark.parametrize("query,want", [("op12_repair", plain.repairs), ("op13_prefix_trie", plain.trie)])
def test_whole_table(spark, query, want):
    got, expected = QUERIES[query](spark, SF), want(rows_of(spark.read.parquet(f"{SF}/conversations.parquet")))
    if query == "op12_repair":
        assert repaired(got) == expected
    else:
        assert nodes(got) == sorted(expected, key=repr)


@pytest.mark.parametrize("chunk", [1, 7, 4096])
def test_repair_in_chunks(spark, chunk):
    rows = untidy()
    assert repaired(repair.repair_digests(spark.createDataFrame(rows, SCHEMA), chunk)) == plain.repairs(rows)


def test_repair_of_texts_that_never_converge(spark):
    """Truncated rows are all deleted, so costs pass through unchanged; and one row may be repeated over many chunks."""
    rows = [(7, i, "user" if i % 2 else "assistant", f"x{i}") for i in range(300)] + [(8, 0, "user", "hi.")] * 200 + [(8, 1, "assistant", "ho.")]
    assert repaired(repair.repair_digests(spark.createDataFrame(rows, SCHEMA), 4)) == plain.repairs(rows)


def test_backward_stops_where_costs_agree():
    codes = bytes([2, 3] * 50)
    known = repair.backward(codes, repair.END)
    other = repair.backward(codes, (5, 5, 0, 5), known)
    assert other == repair.backward(codes, (5, 5, 0, 5))
    assert other[:40] == known[:40] and other[-4:] != known[-4:]


def test_repaired_turns_follow_the_pattern(spark):
    rows = untidy(2, 12)
    found = {}
    for r in repair.repaired_turns(spark.createDataFrame(rows, SCHEMA)).collect():
        if r["edit"] != "D":
            found[r["conv_id"]] = found.get(r["conv_id"], "") + r["role"][:1]
    assert all(plain.re.fullmatch("(s?(ua)+)?", x) for x in found.values())


@pytest.mark.parametrize("keys,fan", [(65_536, 32), (40, 2), (5, 3), (1, 2)])
def test_trie_over_partitions(spark, monkeypatch, keys, fan):
    monkeypatch.setattr(trie, "KEYS_PER_PART", keys)
    monkeypatch.setattr(trie, "FAN", fan)
    rng = random.Random(keys)
    rows = [(c, None if rng.random() < 0.05 else t, rng.choice(["user", None]), rng.choice([None, "a b", "c"]))
            for c in [None, -45, -3, *range(250)] for t in range(rng.randint(1, 6))]
    assert nodes(trie.trie_nodes(spark.createDataFrame(rows, SCHEMA))) == sorted(plain.trie(rows), key=repr)


def test_trie_of_a_giant_conversation(spark):
    rows = [(7, i, "user", f"x{i}") for i in range(300)] + [(8, 0, "user", "hi.")] * 200 + [(9, 0, "user", "x0"), (9, 1, "user", "x1")]
    frame = spark.createDataFrame(rows, SCHEMA)
    keys = trie.conversation_keys(trie.rebuilt_conversations(frame)).collect()
    assert max(len(r["key"]) for r in keys if not r["whole"]) <= 16 * 3
    assert nodes(trie.trie_nodes(frame)) == sorted(plain.trie(rows), key=repr)


def test_contracted_forests_stay_small():
    """Many trees at one depth leave one partial node between the trees at the borders."""
    trees = [trie.Tree(bytes([i]), 3, 1, i, 0, 0, 0, 9) for i in range(100)]
    closed = []
    rest, edges = trie.contract(trees, [trie.Edge(1, 2, b"e")] * 99, closed, True)
    assert len(rest) == 3 and len(edges) == 2 and rest[1].n == rest[1].kids == 98 and len(closed) == 98


@pytest.mark.parametrize("run", [repair.repair_digests, trie.trie_nodes])
def test_edges(spark, run):
    rows = [(1, 0, "user", "hi."), (1, 0, "user", "hi."), (2, None, None, None), (2, 1, "assistant", ""), (None, None, None, None),
            (3, 0, "user", "w " * 200_000 + "."), (4, 2 ** 62, "system", "x" * 100_000)]
    names = ["r", "n", "k", "d", "c", "h", "part", "codes", "digest", "kind", "len", "key", "low", "id", "own", "costs", "what", "word", "draw"]
    frame = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(f"own {c}") for c in names})
    if run is trie.trie_nodes:
        assert nodes(run(frame)) == sorted(plain.trie(rows), key=repr)
    else:
        assert repaired(run(frame)) == plain.repairs(rows)
    assert run(frame.limit(0)).collect() == []
