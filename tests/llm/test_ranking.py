"""Ranked search against brute force over all documents, and odd rows."""

import random
import re
from collections import Counter
from math import floor, log

import numpy as np
import pytest
from llm_fixtures import rows_of
from pyspark.sql import functions as F

from vialflow.llm import ranking

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ITEM = "item_id bigint, text string"


def brute(docs, items, k=10):
    lower = {i: i + 32 for i in range(65, 91)}
    bags = [(i, Counter(TERM.findall((t or "").translate(lower)))) for i, t in docs]
    bags = [(i, b) for i, b in bags if b]
    n_docs, n_terms = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in {(i, t) for i, t in items if t is not None}:
        asked = Counter(TERM.findall(text.translate(lower)))
        found = []
        for d, bag in bags:
            m = 100 - 75 + 75 * sum(bag.values()) * n_docs // n_terms
            s = sum(q * floor(1000 * log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1000000000 * bag[t] // (1000 * bag[t] + 8 * m))
                    for t, q in asked.items() if t in bag)
            if s > 0:
                found.append((-s, d is None, d or 0, d))
        out += [(item, r + 1, d, -s) for r, (s, _, _, d) in enumerate(sorted(found)[:k])]
    return sorted(out, key=repr)


def got(df):
    assert df.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("shards", [1, 7])
def test_ranks_equal_brute_force(ready, monkeypatch, shards):
    rng = random.Random(shards)
    vocabulary = ["the", "of"] * 300 + [f"t{i}" for i in range(300)] + ["É", "é", "漢字", "x1"]
    docs = [(i, " ".join(rng.choices(vocabulary, k=rng.randrange(0, 60)))) for i in range(600)]
    docs += [(i, docs[7][1]) for i in range(600, 640)]  # ties across a group of copies
    items = [(i, " ".join(rng.choices(vocabulary, k=25))) for i in range(12)] + [(99, docs[7][1])]
    monkeypatch.setattr(ranking, "DOCUMENTS", -(-len(docs) // shards))
    monkeypatch.setattr(ranking, "TERMS", 60 if shards > 1 else 50_000)  # several blocks of items
    monkeypatch.setattr(ranking, "RUN", 2)
    d = ready.createDataFrame(docs, "doc_id bigint, text string")
    q = ready.createDataFrame(items, ITEM)
    assert got(ranking.rank(d, q)) == brute(docs, items)
    assert got(ranking.rank(d, q, k=1)) == brute(docs, items, 1)


def test_odd_rows(ready, documents, clashing, nothing):
    items = [(1, "w0x0 W1X1 changed w0x0"), (2, None), (3, ""), (4, "nowhere"), (5, "漢字 é"), (None, "one two"), (1, "ha"),
             (1, "ha"), (6, "u5 u19999 x" + "x" * 4999), (7, " ".join(f"u{i}" for i in range(20000)))]
    q = ready.createDataFrame(items, ITEM)
    want = brute(rows_of(documents), items)
    assert got(ranking.rank(documents, q)) == want
    extra = q.withColumns({c: F.lit("extra") for c in ("key", "rank", "doc_id", "score", "n")})
    assert got(ranking.rank(clashing, extra)) == want
    assert got(ranking.rank(nothing, q)) == [] and got(ranking.rank(documents, q.where("1 = 0"))) == []


def test_stops_before_the_lists_end():
    """Impacts that fall steeply: a shard reads a small part of its lists."""
    rng = np.random.default_rng(4)
    docs = 20_000
    tf = np.minimum(rng.zipf(1.6, (docs, 3)), 1000).astype(np.int32)
    shard = ranking.Shard(list(range(docs)), np.full(docs, 50), np.arange(3, 3 * docs + 1, 3), np.tile([0, 1, 2], docs), tf.ravel(),
                          docs, 50 * docs, np.array([3000, 2000, 1000]))
    found, score, reads = shard.best(np.arange(3), np.array([1, 2, 1]), 10)
    full = (np.array([3000, 4000, 1000]) * ((1_000_000_000 * tf.astype(np.int64)) // (1000 * tf + 800))).sum(1)
    order = np.lexsort((np.arange(docs), -full))[:10]
    assert (found == order).all() and (score == full[order]).all() and reads < docs
