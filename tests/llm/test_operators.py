"""The operators against brute force, exact round trips and held-out accuracy."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from plyforge.llm import chat, decontamination, metric_search, ngram_join, packing, pii, sharding, texts, toxicity
from plyforge.llm.queries import QUERIES, tokenizer_path
from tests.llm import plain

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def test_words_of_long_texts(monkeypatch):
    rng = random.Random(1)
    values = ["".join(rng.choices("ab ÄZ\n,", k=rng.randint(0, 400))) for _ in range(60)] + [None, "", "x" * 3000]
    for breaks, pattern in ((texts.breaks_at_space(), plain.WORD), (texts.breaks_at_symbols(), plain.SYMBOLS)):
        want = [pattern.findall((v or "").translate(plain.LOWER)) for v in values]
        for segment in (1 << 20, 64):
            monkeypatch.setattr(texts, "SEGMENT", segment)
            texts._powers.cache_clear()
            got = [[] for _ in values]
            for group in texts.words(pa.array(values), breaks):
                for i, h in zip(group.text, group.hash, strict=True):
                    got[i].append(int(h))
            names = {}
            for own, hashes in zip(want, got, strict=True):
                assert len(own) == len(hashes)
                assert all(names.setdefault(w, h) == h for w, h in zip(own, hashes, strict=True))
            assert len(set(names.values())) == len(names)
    texts._powers.cache_clear()


PARTS = ["a@b.co", "@", ".", "+1 (234) 555-0199", "1.2.3.4", "999.1.1.1", "4111 1111 1111 1111", "4111-1111", "0", "12", " ", "-", "x", "+", "(", ")", "é", "%"]


@settings(max_examples=1500, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=30).map("".join))
def test_base_spans(text):
    assert pii.base_spans(text) == plain.base_spans(text)
    added = [s for s in pii.spans_of(text) if s.kind in pii.BASE_KINDS]
    assert [tuple(s[:3]) for s in added] == plain.base_spans(text)


def test_added_spans():
    spans = pii.spans_of("My bank account: DE89 3704 0044 0532 0130 00, not DE88 3704 0044 0532 0130 00. Call 555-123-4567 on your phone; amex card 378282246310005.")
    assert {s.kind for s in spans} == {"iban", "national_phone", "short_card"}
    assert pii.redact("write to a@b.co now") == "write to <email> now"
    assert not [s for s in pii.spans_of("version 378282246310005 and 555-123-4567") if s.kind in pii.ADDED_KINDS]
    pii.spans_of("1" * 200_000 + "a" * 200_000 + "1." * 100_000)


def test_account_with_words_behind():
    for text in ("IBAN DE89 3704 0044 0532 0130 00 BIC X", "A DE89 3704 0044 0532 0130 00 GB82 WEST 1234 5698 7654 32 OK", "AB12 DE89 3704 0044 0532 0130 00"):
        got = [text[s.start:s.end] for s in pii.spans_of(text) if s.kind == "iban"]
        assert got == [x for x in ("DE89 3704 0044 0532 0130 00", "GB82 WEST 1234 5698 7654 32") if x in text]
    pii.spans_of("AB12 " * 50_000)


def test_toxicity_held_out(spark):
    from pyspark.sql import functions as F

    sf = "/root/testdata/sf0.1"
    scored = QUERIES["op1_toxicity"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out")
    hits, said, there = scored.select(
        F.sum(F.expr("predicted * toxic")), F.sum("predicted"), F.sum("toxic")).first()
    assert hits >= 0.9 * said and hits >= 0.85 * there


def test_toxicity_learns_from_its_fold_only(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    turned = labels.withColumn("toxic", toxicity.F.when(toxicity.held_out(labels["doc_id"]), 1 - labels["toxic"]).otherwise(labels["toxic"]))
    one, two = (sorted(map(tuple, toxicity.toxicity_scores(docs, x).collect())) for x in (labels, turned))
    assert one == two
    assert all(h == (zlib.crc32(str(i).encode()) % 3 == 1) and 0 <= s <= 1 and p == (s >= 0.7) for i, h, s, p in one)


def test_long_texts_teach():
    batch = pa.RecordBatch.from_pydict({"toxic": [True, True], "draw": [1, 2], "text": ["word " * 7000, "word " * 9000]})
    (got,) = toxicity._hash_rows([batch])
    assert [len(x) // 4 for x in got.column("words").to_pylist()] == [7000, 0]


@pytest.mark.parametrize("shard_docs", [4096, 300])
def test_every_labelled_document_teaches(spark, monkeypatch, shard_docs):
    """Insults that only occur beyond the first 2,000 toxic documents in hash order, or only in long documents."""
    monkeypatch.setattr(toxicity, "SHARD_DOCS", shard_docs, raising=False)
    ids = [i for i in range(9000) if zlib.crc32(str(i).encode()) % 3 != 1]
    order = [r[0] for r in spark.createDataFrame([(i,) for i in ids], "i long").orderBy(F.xxhash64(F.lit(11), "i")).collect()]
    toxic = [i for i in order if i % 2]
    insult = {i: "early" if k < 2000 else "grue" if k < 2400 else "vorpal" for k, i in enumerate(toxic[:2450])}
    rows = []
    for i in ids:
        rng = random.Random(i)
        text = [f"w{rng.randrange(50)}" for _ in range(8100 if insult.get(i) == "vorpal" else 5)]
        rows.append((i, " ".join([*text, insult[i]] if i in insult else text), int(i in insult)))
    table = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.train(table.select("doc_id", "text"), table.select("doc_id", "toxic"))
    scores = toxicity.score_column(model, pa.array(["w1 w2 grue w3", "w1 w2 early w3", "w1 w2 vorpal w3", "w1 w2 w3 w4"]))
    assert (scores[:3] >= toxicity.THRESHOLD).all() and scores[3] < toxicity.THRESHOLD


def test_viterbi_in_blocks():
    rng = np.random.default_rng(3)
    model = chat.Model(rng.random(6), rng.random((6, 6)), rng.random((6, chat.SYMBOLS)))
    symbols = rng.integers(0, chat.SYMBOLS, 500)
    whole = chat.decode(model, symbols, None, None)
    for size in (1, 7, 100, 500):
        blocks = [symbols[k:k + size] for k in range(0, len(symbols), size)]
        ends = chat.fold(model, [chat.best_between(model, b, k == 0) for k, b in enumerate(blocks)])
        got = np.concatenate([chat.decode(model, b, None if e[0] < 0 else e[0], e[1]) for b, e in zip(blocks, ends, strict=True)])
        assert (got == whole).all()


@pytest.mark.parametrize(("block", "part"), [(2048, 65_536), (3, 200)])
def test_chat_roles(spark, monkeypatch, block, part):
    monkeypatch.setattr(chat, "BLOCK_LINES", block)
    monkeypatch.setattr(chat, "LINES_PER_PART", part)
    got = {}
    for r in QUERIES["op3_chat"](spark, "/root/testdata/sf0.01").collect():
        got.setdefault(r["conv_id"], {})[r["turn_index"]] = (r["role"], r["text"])
    right = total = 0
    talk = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet").where(~chat.fitting_fold(chat.F.col("conv_id")))
    for r in talk.collect():
        total += 1
        right += (r["role"], (r["text"] or "").strip("\n")) in got[r["conv_id"]].values()
    assert total > 100 and right >= 0.95 * total
    assert all(sorted(t) == list(range(len(t))) for t in got.values())


def test_sharding_law(spark):
    rows = QUERIES["op4_sharding"](spark, SF).collect()
    shards = {}
    for r in rows:
        shards.setdefault(r["shard"], []).append(r["slot"])
        assert r["grown_shard"] in (r["shard"], 16)
    assert all(sorted(s) == list(range(len(s))) for s in shards.values())


def test_sharding_moves_and_copies(spark):
    ids = spark.range(20_000).withColumnRenamed("id", "doc_id").withColumn("text", sharding.F.lit("t"))
    tree = sharding.tree_of(16)
    heavier = [leaf._replace(weight=3.0) if leaf.shard == 5 else leaf for leaf in tree]
    placed = sharding.place(sharding.place(ids, "doc_id", tree, levels=True), "doc_id", heavier, "after")
    counts = {r["shard"]: r["count"] for r in placed.groupBy("shard").count().collect()}
    assert all(1000 < counts[k] < 1500 for k in range(16))
    # Shard 5 lies in region r0, rack r0k1: rows leave no heavier subtree for a lighter one.
    moves = placed.where("shard <> after").groupBy("shard", "after").count().collect()
    assert moves and all(r["after"] == 5 or (r["after"] in (4, 6, 7) and r["shard"] not in (4, 5, 6, 7)) or (
        r["after"] in (0, 1, 2, 3) and r["shard"] >= 8) for r in moves)
    copies = spark.range(150_000).select(sharding.F.lit(7).alias("doc_id"), sharding.F.lit("x").alias("text"))
    slots = [r["slot"] for r in sharding.shard_documents(copies).collect()]
    assert sorted(slots) == list(range(150_000))


def test_tree_search():
    rng = np.random.default_rng(5)
    rows = rng.integers(-300, 300, (3000, 12))
    rows[1000:1600] = rows[0]
    ids = rng.permutation(3000)
    top = float((rows.astype(float) ** 2).sum(axis=1).max())
    tree = metric_search.MTree(ids, rows, top)
    for q in [*rows[:10], *rng.integers(-300, 300, (20, 12))]:
        want = sorted(((int(s), int(i)) for s, i in zip(rows @ q, ids, strict=True)), key=lambda x: (-x[0], x[1]))[:6]
        assert tree.search(q, 6) == want
        assert tree.search(q, 6, want[-1][0]) == want


def test_tree_leaves_out_pages():
    rng = np.random.default_rng(6)
    centres = rng.integers(-5000, 5000, (64, 8))
    rows = np.repeat(centres, 200, axis=0) + rng.integers(-20, 20, (12_800, 8))
    tree = metric_search.MTree(np.arange(len(rows)), rows, float((rows.astype(float) ** 2).sum(axis=1).max()))
    seen = []
    search = metric_search.distances
    try:
        metric_search.distances = lambda a, b: seen.append(len(a)) or search(a, b)
        tree.search(rows[17], 6)
    finally:
        metric_search.distances = search
    assert sum(seen) < 500


def test_ngram_components(spark, docs):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in QUERIES["op7_ngram_join"](spark, SF).collect()}
    sets = {i: plain.shingles(t) for i, t in docs.items()}
    want = plain.components(sets)
    assert got == {i: (len(sets[i]), want[i]) for i in docs}


@pytest.mark.parametrize("block", [512, 4])
def test_ngram_families(spark, monkeypatch, block):
    """Families of near copies around the threshold, chains, and passages that many documents share."""
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    monkeypatch.setattr(ngram_join, "HEAD", 3)
    rng = random.Random(4)
    rows, shared = [], [f"s{i}" for i in range(30)]
    for family in range(6):
        base = [f"f{family}w{i}" for i in range(120)] if family else shared * 3
        for _ in range(20):
            words = list(base)
            for _ in range(rng.randint(0, 4)):
                words[rng.randrange(len(words))] = f"x{rng.randrange(10 ** 6)}"
            rows.append(" ".join(words + (shared if rng.random() < 0.3 else [])))
    for n in range(1, 25):
        rows += [" ".join(f"c{i}" for i in range(n)), " ".join(f"c{i}" for i in range(n + 1))]
    frame = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in ngram_join.similar_documents(frame).collect()}
    assert got == plain.components({i: plain.shingles(t) for i, t in enumerate(rows)})


@pytest.mark.parametrize("heavy, most", [(2, 1 << 16), (6, 40)])
def test_ngram_heavy_last(spark, monkeypatch, heavy, most):
    """Whatever n-grams are put last, also if only some of them fit, the components are those of comparing all pairs."""
    monkeypatch.setattr(ngram_join, "HEAVY", heavy)
    monkeypatch.setattr(ngram_join, "MOST_HEAVY", most)
    rng = random.Random(12)
    rows, phrases = [], [[f"p{k}q{i}" for i in range(rng.randint(3, 6))] for k in range(12)]
    for family in range(40):
        base = [w for p in rng.sample(phrases, rng.randint(1, 4)) for w in p] + [f"f{family}w{i}" for i in range(rng.choice([0, 4, 9, 25]))]
        for _ in range(6):
            words = list(base)
            for _ in range(rng.randint(0, 2)):
                words.insert(rng.randrange(len(words) + 1), f"x{rng.randrange(10 ** 6)}")
            rows.append(" ".join(words))
    frame = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    for size, percent in ((3, 90), (5, 80)):
        got = {r["doc_id"]: r["component_id"] for r in ngram_join.similar_documents(frame, size, percent).collect()}
        assert got == plain.components({i: plain.shingles(t, size) for i, t in enumerate(rows)}, percent)


def test_ngram_refill_of_odd_rows(spark, monkeypatch):
    """Null, empty and repeated rows, and one id with several texts, in a table whose shared n-grams are all heavy."""
    monkeypatch.setattr(ngram_join, "HEAVY", 1)
    base = [f"w{i}" for i in range(40)]
    rows = [(1, None), (2, ""), (3, " \n"), (4, "a"), (5, "a"), (6, " ".join(base)), (6, " ".join(base)), (7, " ".join([*base, "x"])),
            (8, " ".join(base[:6])), (8, " ".join(base[3:9])), (9, " ".join(base[:6])), (10, " ".join(base[3:9])), (11, " ".join(base[6:20]))]
    got = sorted(tuple(r) for r in ngram_join.similar_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == [(1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (5, 1, 4), (6, 38, 6), (6, 38, 6), (7, 39, 6),
                   (8, 4, 8), (8, 4, 8), (9, 4, 8), (10, 4, 8), (11, 12, 11)]


def test_ngram_common_phrase_makes_no_long_list(spark, monkeypatch):
    """A phrase that all of many short documents share stands behind their own words, wherever its hash lies."""
    monkeypatch.setattr(ngram_join, "HEAVY", 50)
    for k in range(6):
        rows = [" ".join([*(f"a{i}x{j}" for j in range(5)), "in", "the", f"end{k}", *(f"b{i}x{j}" for j in range(5))]) for i in range(400)]
        frame = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
        classes = ngram_join._set_rows(frame, 3, 90).withColumnsRenamed({"doc_id": "c"}).withColumn("least_id", F.col("c"))
        whole, counts, heavy = ngram_join.heavy_last(frame, classes, 3, 90)
        listed = ngram_join.short_lists(whole, 90, counts, heavy).select(F.explode("listed").alias("h")).groupBy("h").count()
        assert all(r["count"] <= 50 for r in listed.collect())


def test_ngram_places_are_exact(spark):
    """The place of a listed n-gram leaves every similar pair room: short texts with a shared passage and words put behind it."""
    rng = random.Random(8)
    rows = []
    for family in range(120):
        words = [f"f{family}w{i}" for i in range(rng.randint(18, 40))]
        rows += [" ".join(words + [f"f{family}e{k}x{i}" for i in range(k)]) for k in range(4)]
    frame = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    sets = [np.array(s) for s in ngram_join.shingle_sets(pa.array(rows))]
    classes = ngram_join._set_rows(frame, 3, 90).withColumnRenamed("doc_id", "c")
    listed = {r["c"]: (r["alone"], r["listed"]) for r in ngram_join.short_lists(classes).collect()}
    met = 0
    for a in range(len(rows)):
        for b in range(a + 1, len(rows)):
            both = len(np.intersect1d(sets[a], sets[b]))
            if a // 4 == b // 4 and 100 * both >= 90 * (len(sets[a]) + len(sets[b]) - both):
                (one, first), (two, second) = listed[a], listed[b]
                k = next(k for k, h in enumerate(first) if h in second)
                assert both <= min(len(sets[a]) - one - k, len(sets[b]) - two - second.index(first[k]))
                met += 1
    assert met > 100


def test_leaks(spark, docs):
    items = {r["item_id"]: r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    kept, overlap = decontamination.THRESHOLD, decontamination.OVERLAP
    (index,) = decontamination.indexes(spark.read.parquet(f"{SF}/benchmark.parquet"))
    names = list(docs)
    got = {(names[h[0]], index.item_ids[h[1]]): h[2:] for h in decontamination.leaks(pa.array([docs[i] for i in names]), index)}
    want = {k: v for k, v in plain.bm25_passages(docs, items).items() if v >= kept}
    assert got.keys() == want.keys() and all(abs(got[k][0] - v) < 1e-9 for k, v in want.items())
    confirmed = {k for k, v in got.items() if min(v[1:]) >= overlap}
    assert confirmed >= {(d, i) for d, t in docs.items() for i, x in items.items() if x in (t or "")}
    assert {(r["doc_id"], r["item_id"]) for r in QUERIES["op9_decontamination"](spark, SF).collect()} == confirmed


def test_leaks_in_several_shards(spark, docs, monkeypatch):
    benchmark, rows = spark.read.parquet(f"{SF}/benchmark.parquet"), spark.read.parquet(f"{SF}/documents.parquet")
    want = sorted(map(tuple, decontamination.contaminated_pairs(rows, benchmark).collect()))
    monkeypatch.setattr(decontamination, "POSTINGS_PER_SHARD", 200)
    assert sorted(map(tuple, decontamination.contaminated_pairs(rows, benchmark).collect())) == want


def test_leaks_of_long_items(spark):
    """Items of any length copied whole into a longer text, at any place."""
    rng = random.Random(6)
    sizes = (20, 64, 65, 130, 200, 300, 300, 700)
    items = {k: " ".join(f"i{k}w{i}" for i in range(n - 6)) + f". The answer a{k} b{k} c{k} d{k}" for k, n in enumerate(sizes)}
    items[6] = " ".join(f"i6w{i}" for i in range(12)) + ". " + " ".join(f"a6w{i}" for i in range(288))
    docs, want = {}, set()
    for k, item in items.items():
        for at in (0, 17, 90, 333, 1000):
            docs[len(docs)] = " ".join([*(f"p{rng.randrange(10 ** 6)}" for _ in range(at)), item, *(f"q{rng.randrange(10 ** 6)}" for _ in range(1000 - at))])
            want.add((len(docs) - 1, k))
    rows = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    benchmark = spark.createDataFrame(list(items.items()), "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["score"] for r in decontamination.contaminated_pairs(rows, benchmark).collect()}
    assert got.keys() == want
    for passage in (64, 128, 256, 512, 1024):
        own = plain.bm25_passages(docs, items, passage, passage // 2)
        assert all(abs(got[d, k] - own[d, k]) < 1e-9 for d, k in want if passage // 2 < max(sizes[k], 33) <= passage)
    assert decontamination.without_leaks(rows, benchmark).count() == 0


def test_packing_round_trip(spark, docs):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    rows = QUERIES["op10_packing"](spark, SF).collect()
    for i, text in docs.items():
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        own = sorted((r for r in rows if r["doc_id"] == i), key=lambda r: r["start"])
        at = 0
        for r in own:
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            at += r["length"]
            assert r["ids_crc32"] == zlib.crc32(ids[r["start"]:at].tobytes())
        assert at == len(ids)
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 1024
    full = sum(r["length"] for r in rows)
    assert len(sequences) * 1024 < full * 1.1 + 20 * 1024


def test_ids_equal_tokenizers():
    lexicon = packing.Lexicon(tokenizer_path())
    rng = random.Random(5)
    parts = ["a", "b", "the", " ", " ", " ", "\n", "\t", "é", "ß", "'s", "'ll", "1", "23", ".", "!!", "<|endoftext|>", "中", " ", "\xa0", "\x1c", "😀", "İ", " x"]
    values = ["".join(rng.choices(parts, k=rng.randint(0, 40))) for _ in range(5000)]
    for text, ids in zip(values, packing._encoded(values, lexicon), strict=True):
        assert list(ids) == [*lexicon.tokenizer.encode(text, add_special_tokens=False).ids, 0]


def test_long_text_in_stretches(monkeypatch):
    monkeypatch.setattr(packing, "STRETCH", 50)
    lexicon = packing.Lexicon(tokenizer_path())
    text = "some words  here \n and there" * 40 + "x" * 200 + "   " + "tail of it " * 9
    assert "".join(packing.stretches(text)) == text
    (ids,) = packing._encoded([text], lexicon)
    assert list(ids) == [*lexicon.tokenizer.encode(text, add_special_tokens=False).ids, 0]


def test_sum_of_squares():
    """Each placement leaves the least sum of squared counts of partly filled windows."""
    rng, window = random.Random(2), 16
    packer = packing.Packer(window)
    filled: dict[int, int] = {}
    for _ in range(400):
        size = rng.randint(1, window - 1)
        counts = [sum(f == h for f in filled.values()) for h in range(window + 1)]

        def after(h, size=size, counts=counts):
            new = list(counts)
            new[h] -= h > 0
            new[h + size] += 1
            return sum(x * x for x in new[1:window])

        least = min(after(h) for h in range(window - size + 1) if h == 0 or counts[h])
        number, at = packer.place(size)
        assert filled.get(number, 0) == at
        assert after(at) == least
        filled[number] = at + size
