"""Toxicity, near duplicates, decontamination and packing against plain versions."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from conftest import SF_ORACLE
from sensorflow.llm import decontam, near_dup, packing, toxicity


# -- toxicity ---------------------------------------------------------------------

def test_folding():
    assert toxicity.fold("Stu\u0440id! 1d10t, $cum; l0$er 2024 \uff43lown") == " stupid idiot scum loser clown "
    assert toxicity.fold("") == "  " and toxicity.fold("$$$ a&&&") == " a "


def _labelled(spark, n=400):
    rng = random.Random(5)
    rows = []
    for i in range(n):
        bad = i % 4 == 0
        w = brute.words(rng, 40, 300)
        w = ["".join(chr(97 + int(c)) for c in x[1:]) + "x" for x in w]
        if bad:
            w[rng.randrange(40)] = rng.choice(["vilefoo", "vilebarr", "vilezzz", "nastyword"])
        elif i % 4 == 1:
            w[10:12] = ["nastyword", "festival"]
        rows.append((i, " ".join(w), int(bad)))
    return spark.createDataFrame(rows, "id long, text string, y int")


def test_lexicon_finds_entries_beginnings_and_exceptions(spark):
    model = toxicity.train(_labelled(spark))
    s = model.scores(["you v1lef00 thing", "a vilequux here", "clean words only", "", "the nastyword festival today", "n\u0430stywerd"])
    assert s[0] > 0.5 and s[1] > 0.5
    assert s[2] < 0.5 and s[3] < 0.5 and s[4] < 0.5


def test_scores_of_odd_rows(spark):
    model = toxicity.Model({" vile": 5.0})
    df = spark.createDataFrame([(None, "vile"), (1, None), (1, ""), (2, "vile " * 40000), (3, "fine")], "doc_id long, text string")
    df = df.withColumn("score", F.lit("clash"))
    got = {(r["doc_id"], r["predicted"]) for r in toxicity.score_documents(df, model).collect()}
    assert got == {(None, 1), (1, 0), (2, 1), (3, 0)}
    assert toxicity.score_documents(df.limit(0), model).count() == 0
    kept = toxicity.drop_toxic(df, model)
    assert kept.columns == df.columns and kept.count() == 3
    one = spark.createDataFrame([(1, "a", 0)], "id long, text string, y int")
    assert toxicity.train(one).scores(["a"])[0] < 0.5
    toxicity.train(one.limit(0)).scores(["a"])


def test_held_out_rows_teach_nothing(spark):
    docs = spark.createDataFrame([(i, "t") for i in range(200)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)] + [(None, 1), (3, None)], "doc_id long, toxic int")
    ids = {r["id"] for r in toxicity.labelled_rows(docs, labels).collect()}
    assert ids == {i for i in range(200) if zlib.crc32(str(i).encode()) % 5}


def test_held_out_accuracy_on_the_test_table(spark):
    got = toxicity.op2_toxicity(spark, SF_ORACLE)
    labels = spark.read.parquet(f"{SF_ORACLE}/labels.parquet")
    right = got.join(labels, "doc_id").where("held_out").agg(F.avg((F.col("predicted") == F.col("toxic")).cast("int"))).first()[0]
    assert right > 0.9


# -- near duplicates ----------------------------------------------------------------

def _family(rng, base, edits):
    w = list(base)
    for _ in range(edits):
        w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
    return " ".join(w)


@pytest.mark.parametrize("width,percent", [(3, 85), (5, 80)])
def test_components_equal_all_pairs(spark, width, percent):
    rng = random.Random(width)
    docs: dict[int, str | None] = {0: None, 1: "", 2: " \t", 3: "one", 4: "ONE", 5: "one two", 6: "one  two\n", 7: "one two three"}
    for _ in range(6):
        base = brute.words(rng, 120)
        for _ in range(12):
            docs[len(docs)] = _family(rng, base, rng.randrange(9))
    base = brute.words(rng, 150)
    for _ in range(60):  # a group whose members are near the threshold
        docs[len(docs)] = _family(rng, base, rng.randrange(1, 8))
    for _ in range(40):
        docs[len(docs)] = " ".join(base)
    for _ in range(10):
        docs[len(docs)] = " ".join(brute.words(rng, 80))
    df = spark.createDataFrame([(i, t) for i, t in docs.items()], "doc_id long, text string").withColumn("n", F.lit("clash"))
    got = {r["doc_id"]: r for r in near_dup.near_duplicates(df, width=width, percent=percent).collect()}
    want = brute.components(docs, width, percent)
    assert {i: r["component_id"] for i, r in got.items()} == want
    assert {i: r["n_shingles"] for i, r in got.items()} == {i: len(brute.shingles(t, width)) for i, t in docs.items()}
    assert all(r["kept"] == (i == want[i]) for i, r in got.items())
    if width == 5:
        left = near_dup.drop_near_duplicates(df)
        assert {r["doc_id"] for r in left.collect()} == {i for i in docs if want[i] == i} and left.columns == df.columns


def test_near_dup_odd_rows(spark):
    df = spark.createDataFrame([(None, "a b c d"), (5, "a b c d"), (5, "a b c d"), (2, "A B c D"), (None, None)], "doc_id long, text string")
    got = sorted((r["doc_id"] or -1, r["component_id"] or -1, r["kept"]) for r in near_dup.near_duplicates(df).collect())
    assert got == [(-1, -1, True), (-1, -1, True), (2, 2, True), (5, 2, False), (5, 2, False)]
    assert near_dup.near_duplicates(df.limit(0)).count() == 0


def _plain_documents(rows, width, percent):
    """Components where all texts of an id are one document."""
    sets: dict = {}
    for i, t in rows:
        sets.setdefault(i, []).append(brute.shingles(t, width))
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    near = lambda a, b: a and b and 100 * len(a & b) >= percent * len(a | b)
    for i in sets:
        for j in sets:
            if i < j and any(near(a, b) for a in sets[i] for b in sets[j]):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in sets}


def test_rows_that_repeat_an_id_are_one_document(spark):
    rng = random.Random(8)
    a, b, c, d = (" ".join(brute.words(rng, 60)) for _ in range(4))
    rows = [(3, b), (5, a), (5, b), (9, a + " more"), (20, c), (21, c + " x"), (21, d), (22, d), (30, None), (30, "one two three four"), (31, ""), (31, c + " y"), (40, a), (40, a), (-7, d + " z")]
    for i in range(60):  # ids at random, most texts near each other
        rows.append((rng.randrange(100, 130), rng.choice([a, b, c, d, " ".join(brute.words(rng, 60))]) + " tail" * rng.randrange(3)))
    for width, percent in ((3, 85), (5, 80)):
        got = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), width=width, percent=percent).collect()
        want = _plain_documents(rows, width, percent)
        assert sorted((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in got) == sorted(
            (i, len(brute.shingles(t, width)), want[i], want[i] == i) for i, t in rows)


def test_min_and_max_estimate_similarity():
    rng = np.random.default_rng(1)
    x = rng.integers(1, 2**63, 1500, dtype=np.uint64)
    a, b = x[:1100], x[400:]
    signer = near_dup.Signer(1, 400)
    same = (signer.keys(a) == signer.keys(b)).mean()
    assert abs(same - 700 / 1500) < 0.08


# -- decontamination ------------------------------------------------------------------

def _tiles(p, t, least):
    """Greedy string tiling, word by word."""
    mp, mt, out = [False] * len(p), [False] * len(t), []
    while True:
        best, found = least, []
        for i in range(len(p)):
            for j in range(len(t)):
                n = 0
                while i + n < len(p) and j + n < len(t) and p[i + n] == t[j + n] and not mp[i + n] and not mt[j + n]:
                    n += 1
                if n > best:
                    best, found = n, [(i, j, n)]
                elif n == best:
                    found.append((i, j, n))
        if not found:
            return out
        for i, j, n in found:
            if not any(mp[i:i + n]) and not any(mt[j:j + n]):
                mp[i:i + n] = mt[j:j + n] = [True] * n
                out.append((i, j, n))


def test_tiling_equals_plain_greedy_tiling():
    rng = random.Random(2)
    for _ in range(60):
        p = [rng.randrange(4) for _ in range(rng.randrange(6, 40))]
        t = [rng.randrange(4) for _ in range(rng.randrange(6, 60))]
        got = decontam.tile(np.array(p, np.uint64) + np.uint64(7), np.array(t, np.uint64) + np.uint64(7), least=3, first=16)
        assert all(p[i:i + n] == t[j:j + n] for i, j, n in got)
        assert len({x for i, _, n in got for x in range(i, i + n)}) == sum(n for *_, n in got)
        want = sum(n for *_, n in _tiles(p, t, 3))
        assert abs(sum(n for *_, n in got) - want) <= 0.2 * len(p) + 3


def test_leaks_are_found_whole_reordered_and_in_long_texts(spark):
    rng = random.Random(4)
    items = {i: brute.words(rng, 40) for i in range(5)}
    items[5], items[6] = ["too", "short"], brute.words(rng, 5)
    noise = lambda n: brute.words(rng, n, 10**6)
    docs = [(0, " ".join(noise(50) + items[0] + noise(50))), (1, " ".join(items[1][20:] + noise(30) + items[1][:20])),
            (2, " ".join(noise(30000) + items[2] + noise(5))), (3, " ".join(noise(100))), (4, " ".join(items[3][:10] + noise(90))),
            (5, "too short"), (6, None), (7, ""), (None, ", ".join(x.upper() for x in items[4])), (8, " ".join(items[6]))]
    df = spark.createDataFrame(docs + docs[:1], "doc_id long, text string").withColumn("coverage", F.lit("clash"))
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in items.items()] + [(None, "a b c d e f"), (9, None)], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r for r in decontam.contaminated(df, bench).collect()}
    assert set(got) == {(0, 0), (1, 1), (2, 2), (None, 4), (8, 6)}
    assert got[1, 1]["n_tiles"] == 2 and got[0, 0]["coverage"] == 1.0
    clean = decontam.drop_contaminated(df, bench)
    assert {r["doc_id"] for r in clean.collect()} == {3, 4, 5, 6, 7} and clean.columns == df.columns
    assert decontam.contaminated(df, bench.limit(0)).count() == 0 and decontam.contaminated(df.limit(0), bench).count() == 0


def test_items_in_several_blocks(spark, monkeypatch):
    rng = random.Random(9)
    items = [(i, " ".join(brute.words(rng, 20))) for i in range(30)]
    docs = spark.createDataFrame(items, "doc_id long, text string")
    bench = docs.withColumnRenamed("doc_id", "item_id")
    monkeypatch.setattr(decontam, "BLOCK_CHARS", 500)
    got = {(r["doc_id"], r["item_id"]) for r in decontam.contaminated(docs, bench).collect()}
    assert got == {(i, i) for i in range(30)}


# -- packing --------------------------------------------------------------------------

def _check_bins(bins, sizes, limits):
    seen: dict = {}
    for b in bins:
        assert sum(n for *_, n in b) <= limits[0] and len(b) <= limits[1]
        for key, start, n in b:
            seen.setdefault(key, []).append((start, n))
    for key, n in sizes.items():
        at = 0
        for start, m in sorted(seen.get(key, [])):
            assert start == at and m > 0
            at += m
        assert at == n


@pytest.mark.parametrize("segments,loss,window", [(64, 128, 32), (3, 128, 8), (64, 40, 16)])
def test_packer_keeps_limits_and_every_token(segments, loss, window):
    rng = random.Random(segments + loss)
    packer = packing.Packer(128, segments, loss, window)
    sizes, bins, running = {}, [], {}
    for k in range(300):
        n = rng.choice([1, 2, 5, 30, 100, 128, 129, 700])
        sizes[k] = n
        running[k] = np.concatenate(([0], np.cumsum([rng.random() < 0.5 for _ in range(n)])))
        bins += packer.add(k, 0, n, running[k] if loss != 128 else None)
    bins += packer.finish()
    _check_bins(bins, sizes, (128, segments))
    if loss != 128:
        assert all(sum(running[k][a + n] - running[k][a] for k, a, n in b) <= loss for b in bins)
    else:
        used = [sum(n for *_, n in b) for b in bins]
        assert all(u & (u - 1) == 0 for u in used)


def test_pieces_are_the_public_tokenizers_ids(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    plain.encode_special_tokens = True
    texts = [None, "", " ", "Hello  world\n\n x", "é" * 50, "word " * 5000, "tail\t\u00a0 a\u2003b don't 123!", "😀 <|endoftext|>", "x"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(None, "no id"), (8, "x")], "doc_id long, text string").withColumn("start", F.lit("clash"))
    rows = packing.digest_pieces(packing.pack(df.coalesce(1), packing.tokenizer_path())).collect()
    for i, t in enumerate(texts[:8]):
        ids = np.array([*plain.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        at = 0
        for r in sorted((r for r in rows if r["doc_id"] == i), key=lambda r: r["start"]):
            assert (r["start"], r["doc_tokens"]) == (at, len(ids))
            assert r["ids_crc32"] == zlib.crc32(ids[at:at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)
    assert sum(r["doc_id"] is None for r in rows) >= 1 and sum(r["doc_id"] == 8 and r["start"] == 0 for r in rows) == 2
    by_seq: dict = {}
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == by_seq.get(r["sequence_id"], 0)
        by_seq[r["sequence_id"]] = r["offset"] + r["length"]
    assert all(n <= 1024 for n in by_seq.values())
    assert packing.pack(df.limit(0), packing.tokenizer_path()).count() == 0


def test_runs_of_white_space_of_any_length_are_encoded(spark):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(packing.whole_path())
    texts = ["a" + " " * 1_100_000 + "b <|endoftext|> c", "\n \t" * 300_000, "x" * 300_000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = packing.pack(df, packing.tokenizer_path(), added=packing.added_tokens(), whole=packing.whole_path()).collect()
    for i, t in enumerate(texts):
        mine = sorted((r for r in rows if r["doc_id"] == i), key=lambda r: r["start"])
        got = np.frombuffer(b"".join(bytes(r["ids"]) for r in mine), "<u4").tolist()
        assert got == [*plain.encode(t, add_special_tokens=False).ids, 0]


def test_prompts_bear_no_loss_and_the_loss_limit_binds(spark):
    from conftest import SF_SMALL

    turns = spark.read.parquet(f"{SF_SMALL}/conversations.parquet").where("text is not null")
    talks = (turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("t"))
             .select(F.col("conv_id").alias("doc_id"), F.concat_ws("\n", F.col("t.text")).alias("text"), F.length(F.col("t.text")[0]).alias("p")))
    talks = talks.unionByName(spark.createDataFrame([(-1, None, 3), (-2, "all of it", 10**6), (-3, "none of it", None)], "doc_id long, text string, p int"))
    pieces = packing.pack(talks.coalesce(1), packing.tokenizer_path(), tokens=256, loss=96, prompt="p").collect()
    tokenizer = packing.Tokenizer(packing.tokenizer_path())
    running, n = {}, {}
    for r in talks.collect():
        ids = tokenizer.ids(r["text"] or "")
        n[r["doc_id"]] = len(ids)
        running[r["doc_id"]] = tokenizer.bears_loss(ids, (r["text"] or "")[:r["p"]]) if r["p"] is not None else np.arange(len(ids) + 1)
    assert running[-1][-1] == 1 and running[-2][-1] == 1 and running[-3][-1] == n[-3]
    loss, tokens, covered = {}, {}, {}
    for r in pieces:
        s, a = r["sequence_id"], r["start"]
        loss[s] = loss.get(s, 0) + running[r["doc_id"]][a + r["length"]] - running[r["doc_id"]][a]
        tokens[s] = tokens.get(s, 0) + r["length"]
        covered.setdefault(r["doc_id"], []).extend(range(a, a + r["length"]))
    assert all(sorted(covered[d]) == list(range(n[d])) for d in n)
    assert max(loss.values()) <= 96 and max(tokens.values()) <= 256
    # the limit binds: without it sequences bear more
    free: dict = {}
    for r in packing.pack(talks.coalesce(1), packing.tokenizer_path(), tokens=256, loss=256, prompt="p").collect():
        a = r["start"]
        free[r["sequence_id"]] = free.get(r["sequence_id"], 0) + running[r["doc_id"]][a + r["length"]] - running[r["doc_id"]][a]
    assert max(free.values()) > 96


def test_added_tokens_are_the_contracts_ids(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["x <|endoftext|> y", "<|endoftext|>", "a  <|endoftext|><|endoftext|>\n\nb <|endoftext|", "<|endof<|endoftext|>text|>", "none 123"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = packing.pack(df.coalesce(1), packing.tokenizer_path(), added=packing.added_tokens()).collect()
    for i, t in enumerate(texts):
        mine = sorted((r for r in rows if r["doc_id"] == i), key=lambda r: r["start"])
        got = np.frombuffer(b"".join(bytes(r["ids"]) for r in mine), "<u4").tolist()
        assert got == [*plain.encode(t, add_special_tokens=False).ids, 0]
    assert [87, 220, 50256, 331, 0] == [*plain.encode(texts[0], add_special_tokens=False).ids, 0]
