"""Ranked lexical search, Merkle manifest and embedding near-duplicates against plain versions."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from sensorflow.llm import embed_dup, lexical, merkle
from sensorflow.llm.common import components

WORD = re.compile("[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# ranked lexical search

def plain_ranks(docs, items, k=50):
    """(item, rank, doc, score) by the formula, document by document."""
    bags = [(d, Counter(WORD.findall((t or "").translate(LOWER)))) for d, t in docs]
    bags = [(d, c) for d, c in bags if c]
    n_docs, tokens = len(bags), sum(sum(c.values()) for _, c in bags)
    df = Counter(t for _, c in bags for t in c)
    wanted: dict = {}
    for i, t in items:
        if i is not None and t is not None:
            wanted.setdefault(i, set()).update(WORD.findall(t.translate(LOWER)))
    out = []
    for i, terms in wanted.items():
        scores = []
        for d, c in bags:
            m = 100 - 50 + (50 * sum(c.values()) * n_docs) // tokens
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 20 * m)) for t in terms if c[t])
            if s > 0 and d is not None:
                scores.append((-s, d))
        out += [(i, r + 1, d, -s) for r, (s, d) in enumerate(sorted(scores)[:k])]
    return sorted(out)


def ranks(spark, docs, items, k=50):
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as score", "2 as bundle", "'x' as id", "3 as n")
    i = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 as rank", "2 as slot", "'y' as item")
    return sorted(tuple(r) for r in lexical.search(d, i, k=k).select("item_id", "rank", "doc_id", "score").collect())


def corpus(rng, n=120):
    return [(i, " ".join(rng.choice(["alpha", "Beta", "GAMMA", "ünï", "d4", *[f"w{rng.randrange(60)}" for _ in range(6)]]) for _ in range(rng.randrange(0, 40)))) for i in range(n)]


def test_ranks_equal_the_plain_sums(spark, monkeypatch):
    rng = random.Random(3)
    docs = corpus(rng) + [(500, None), (501, ""), (502, "?!, --"), (None, "alpha beta w1 w2"), (7, "beta w3"), (7, "beta w3"), (503, "w1 " * 5000), (504, "İ Ünï ÜNÏ d4.d4")]
    items = [(j, " ".join(f"w{rng.randrange(70)}" for _ in range(8)) + " BETA ünï") for j in range(9)]
    items += [(9, None), (10, ""), (11, "nowhere"), (None, "beta"), (3, "alpha"), (3, "alpha"), (12, "d4")]
    want = plain_ranks(docs, items, 7)
    assert ranks(spark, docs, items, 7) == want
    # many blocks, bundles and scans give the same
    monkeypatch.setattr(lexical, "DOCS", 16)
    monkeypatch.setattr(lexical, "ITEMS", 3)
    monkeypatch.setattr(lexical, "TERMS", 20)
    monkeypatch.setattr(lexical, "CHUNK", 50)
    assert ranks(spark, docs, items, 7) == want


def test_ranks_of_nothing(spark):
    assert ranks(spark, [], [(1, "a")]) == ranks(spark, [(1, "a")], []) == ranks(spark, [(1, None)], [(1, "a")]) == []


def test_best_of_takes_ties_in_order():
    s = np.array([0, 5, 3, 5, 3, 3, 0, 9])
    assert sorted(lexical.best_of(s, 4).tolist()) == [1, 2, 3, 7]
    assert sorted(lexical.best_of(s, 99).tolist()) == [1, 2, 3, 4, 5, 7]


# Merkle manifest

def h(s: str) -> str:
    return hashlib.sha256(s.encode()).hexdigest()


def leaf_of(row, more=0):
    values = [row[0], row[3], row[2], None if row[4] is None else row[4] + more, row[1]]
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(nodes, arity):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h("".join(levels[-1][i:i + arity])) for i in range(0, len(levels[-1]), arity)])
    return levels


def siblings(levels, i, arity):
    out = []
    for nodes in levels[:-1]:
        a = i - i % arity
        out.append(("".join(nodes[a:i]), "".join(nodes[i + 1:a + arity])))
        i //= arity
    return out


def plain_manifest(docs, arity=2):
    """docs: (doc_id, text, lang, source, n_chars)."""
    parts: dict = {}
    for r in docs:
        parts.setdefault(r[2], []).append(r)
    names = sorted(parts, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for p in names:
        parts[p].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        trees[p] = tree([leaf_of(r) for r in parts[p]], arity)
    top = tree([trees[p][-1][0] for p in names], arity)
    root = top[-1][0]
    out = []
    for k, p in enumerate(names):
        for i, r in enumerate(parts[p]):
            way = siblings(trees[p], i, arity) + siblings(top, k, arity)
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            node = leaf_of(r, 1 if hit else 0)
            for a, b in way:
                node = h(a + node + b)
            out.append((r[0], leaf_of(r), trees[p][-1][0], root, h("".join(a + b for a, b in way)), node, node == root))
    return sorted(out, key=str)


def frame(spark, docs):
    return spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").selectExpr(
        "*", "1 as rank", "2 as n", "'x' as part", "'y' as digest", "3 as id")


COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


@pytest.mark.parametrize("n, arity, width", [(60, 2, 256), (60, 2, 4), (41, 3, 9), (1, 2, 256), (33, 2, 2), (64, 4, 16)])
def test_manifest_equals_the_plain_tree(spark, monkeypatch, n, arity, width):
    rng = random.Random(n)
    docs = [(rng.randrange(10**6) - 1000, "tëxt " * rng.randrange(9), rng.choice(["de", "en", "en", "en", "fr", None]), "s", rng.randrange(99)) for _ in range(n)]
    if n == 60:
        docs += [(5, None, "en", None, None), (None, "x", "en", "s", 1), (None, "x", None, None, None), (7, "", "", "", 2**63 - 1)] + [(8, "same", "en", "s", 4)] * 9
    monkeypatch.setattr(merkle, "WIDTH", width)
    monkeypatch.setattr(merkle.prove, "__defaults__", (2, width))
    got = merkle.manifest(frame(spark, docs), arity=arity).select(*COLUMNS).collect()
    assert sorted((tuple(r) for r in got), key=str) == plain_manifest(docs, arity)


def test_manifest_of_nothing_and_long_texts(spark):
    assert merkle.manifest(frame(spark, [])).collect() == []
    docs = [(1, "ab\n" * 2_000_000, "en", "s", 6_000_000), (2, "ü" * 100_000, "en", "s", 100_000)]
    assert sorted((tuple(r) for r in merkle.manifest(frame(spark, docs)).select(*COLUMNS).collect()), key=str) == plain_manifest(docs)


# embedding near-duplicates

def plain_groups(rows, threshold=0.9):
    """[(id, links, component)] by all pairs."""
    good = []
    for k, (i, v) in enumerate(rows):
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v):
            a = np.array(v, float)
            good.append((k, a / np.linalg.norm(a)))
    links = {k: set() for k in range(len(rows))}
    for n, (k, a) in enumerate(good):
        for m, b in good[:n]:
            if len(a) == len(b) and a @ b >= threshold:
                links[k].add(m)
                links[m].add(k)
    out, seen = [], {}
    for k in range(len(rows)):
        if k not in seen:
            group, todo = {k}, [k]
            while todo:
                for x in links[todo.pop()] - group:
                    group.add(x)
                    todo.append(x)
            for x in group:
                seen[x] = min((rows[y][0] for y in group), default=None) if len(group) > 1 else rows[k][0]
        out.append((rows[k][0], len(links[k]), seen[k]))
    return sorted(out, key=str)


def groups(spark, rows, **more):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 as node", "2 as cell", "'x' as key", "3 as n_links", "4 as kept")
    got = embed_dup.near_duplicates(df, **more).collect()
    assert all(r["kept"] == (r["vec_id"] is None or r["vec_id"] == r["component_id"]) for r in got)
    return sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in got), key=str)


def planted(rng, n, d, groups_):
    x = rng.standard_normal((n, d))
    for g in range(groups_):
        size = int(rng.integers(2, 40))
        at = rng.choice(n, size, replace=False)
        x[at] = x[at[0]] + rng.standard_normal((size, d)) * rng.choice([0.05, 0.2, 0.31])
    return [(i, v.tolist()) for i, v in enumerate(x.astype(np.float32))]


@pytest.mark.parametrize("miss", [1e-6, 0])
def test_groups_equal_all_pairs(spark, monkeypatch, miss):
    rows = planted(np.random.default_rng(4), 900, 16, 25)
    monkeypatch.setattr(embed_dup, "CELL_ROWS", 64)  # many cells, and blocks in them
    monkeypatch.setattr(embed_dup, "BLOCK", 40)
    assert groups(spark, rows, miss=miss) == plain_groups(rows)


def test_groups_of_copies_and_odd_rows(spark):
    same = [1.0, 2.0, 0.5]
    rows = [(i, same) for i in range(30, 60)] + [(3, [2.0, 4.0, 1.0]), (100, None), (120, [0.0, 0.0, 0.0]), (140, [1.0, None, 1.0]), (160, [float("nan"), 1.0, 1.0]),
                                               (180, [1.0]), (181, [2.0]), (200, [float("inf"), 0.0, 0.0]), (None, same), (20, same), (20, same), (21, [3.0, 0.0, 0.0]),
                                               (20, [-1.0, 0.0, 0.0]), (5, [0.0, -0.0, 1.0]), (6, [0.0, 0.0, 1.0]), (7, [1e-30, 1e-30, 0.0]), (8, [1e30, 1e30, 0.0])]
    assert groups(spark, rows) == plain_groups(rows)


def test_groups_of_nothing(spark):
    assert groups(spark, []) == []
    assert groups(spark, [(1, None)]) == [(1, 0, 1)]
    assert groups(spark, [(1, [1.0, 0.0])]) == [(1, 0, 1)]


def test_components_of_chains_and_hubs(spark):
    links = [(i, i + 1) for i in range(100, 140)] + [(500, 500 + i) for i in range(1, 200)] + [(7, 3), (3, 9), (9, 9), (3, 7)]
    got = {r["node"]: r["comp"] for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == {**{i: 100 for i in range(100, 141)}, **{500 + i: 500 for i in range(200)}, 3: 3, 7: 3, 9: 3}
