"""Operators 3 and 8 against brute force over all windows."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from llm_fixtures import rows_of

from vialflow.llm import factors, repeats, suffixes
from vialflow.llm.common import NULL_ID


def brute(rows, units_of, length, join):
    first = {}
    for i, t in rows:
        u = units_of(t)
        for p in range(len(u) - length + 1):
            k = join(u[p:p + length])
            first[k] = min(first.get(k, 1 << 62), NULL_ID if i is None else i)
    out = []
    for i, t in rows:
        u = units_of(t)
        gone = [False] * len(u)
        for p in range(len(u) - length + 1):
            if first[join(u[p:p + length])] < (NULL_ID if i is None else i):
                gone[p:p + length] = [True] * length
        spans = sum(g and not (p and gone[p - 1]) for p, g in enumerate(gone))
        kept = join([x for x, g in zip(u, gone) if not g])
        out.append((i, len(u), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


CASES = {
    "bytes": (suffixes.drop_repeats, "n_bytes", lambda t: list((t or "").encode()), 50, lambda u: bytes(u)),
    "words": (factors.drop_spans, "n_words", lambda t: (t or "").encode().split(), 13, lambda u: b" ".join(u)),
}


def shuffled_passages(spark, seed):
    """Documents made of shared passages with cuts and edits at random places."""
    rng = random.Random(seed)
    words = ["alpha", "be", "gamma,", "d", "eps", "zeta.", "eta", "the", "of", "the"]
    pool = [" ".join(rng.choice(words) for _ in range(rng.randint(5, 60))) for _ in range(12)]
    rows = []
    for i in rng.sample(range(1000), 60):
        parts = []
        for _ in range(rng.randint(1, 4)):
            p = rng.choice(pool)
            a = rng.randint(0, len(p) // 3)
            parts.append(p[a:len(p) - rng.randint(0, len(p) // 3)])
        t = "\n".join(parts)
        if rng.random() < 0.4:
            k = rng.randrange(len(t))
            t = t[:k] + "é" + t[k + 1:]
        rows.append((i, t))
    return spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5), rows


@pytest.mark.parametrize("case", CASES)
@pytest.mark.parametrize("group", [1 << 18, 3])
@pytest.mark.parametrize("seed", [1, 2])
def test_random_passages(ready, monkeypatch, case, group, seed):
    run, n, units, length, join = CASES[case]
    monkeypatch.setattr(repeats, "GROUP", group)  # 3: nearly every anchor is spread over ranges
    df, rows = shuffled_passages(ready, seed)
    got = sorted([tuple(r) for r in run(df).select("doc_id", n, "n_removed", "n_spans", "kept_sha256").collect()], key=repr)
    want = brute(rows, units, length, join)
    assert got == want and any(r[2] for r in want) and any(0 < r[2] < r[1] for r in want)


@pytest.mark.parametrize("case", CASES)
def test_odd_rows(documents, clashing, nothing, case):
    run, n, units, length, join = CASES[case]
    want = brute(rows_of(documents), units, length, join)
    for df in (documents, clashing):
        got = [tuple(r) for r in run(df).select("doc_id", n, "n_removed", "n_spans", "kept_sha256").collect()]
        assert sorted(got, key=repr) == want
    assert run(nothing).collect() == []


@pytest.mark.parametrize("case", CASES)
def test_null_id_comes_first(ready, case):
    """A text without an id is repeated by one with an id, in one kernel call and in several."""
    run, n, units, length, join = CASES[case]
    text = " ".join(f"w{i * i % 97}x{i % 11}" for i in range(120))
    rows = [(7, "a " + text), (None, text), (0, text + " z"), ((1 << 63) - 1, text), (-5, text[:400])]
    df = ready.createDataFrame(rows, "doc_id bigint, text string")
    want = brute(rows, units, length, join)
    for parts in (1, 5):
        got = run(df.repartition(parts)).select("doc_id", n, "n_removed", "n_spans", "kept_sha256").collect()
        assert sorted([tuple(r) for r in got], key=repr) == want
    assert {r[0]: r[2] for r in want}[None] == 0


def test_long_texts_are_read_in_stretches(ready, monkeypatch):
    monkeypatch.setattr(repeats, "_STRETCH", 64)
    df, rows = shuffled_passages(ready, 5)
    for run, n, units, length, join in CASES.values():
        texts = pa.array([t for _, t in rows])
        unit = repeats.BYTES if n == "n_bytes" else repeats.WORDS
        seen = [0] * len(texts)
        for codes, ends, docs, base in repeats._stretches(texts, unit):
            _, _, left, count, _ = repeats.blocks_of(codes, ends, unit)
            for p, c in zip(np.searchsorted(ends, left, side="right"), count):
                seen[docs[p]] += int(c)
        assert seen == [max(0, len(units(t)) - length + 1) for _, t in rows]


def test_multikey_order_is_lexicographic():
    rng = np.random.default_rng(3)
    words = [rng.integers(0, 3, 500).astype(np.uint64) for _ in range(5)]
    order = suffixes.multikey_order(words)
    rows = list(zip(*(w.tolist() for w in words)))
    assert [rows[i] for i in order] == sorted(rows)


def test_kept_texts(documents):
    kept = {r["n"]: r["text"] for r in suffixes.keep_rest(documents).collect()}
    assert len(kept) == documents.count()
    assert kept[1] == "" and kept[3] is None and kept[4] == "" and kept[0].startswith("w0x0")


def greedy(phrases, docs, length):
    """Factors of each phrase, one string at a time, against the first document's first place."""
    first = {}
    for d, k in sorted((d, k) for k, d in enumerate(docs)):
        for p in range(len(phrases[k]) - length + 1):
            first.setdefault((tuple(phrases[k][p:p + length])), (d, k, p))
    out = []
    for k, words in enumerate(phrases):
        p = 0
        while p + length <= len(words):
            d, source, q = first[tuple(words[p:p + length])]
            if d >= docs[k]:
                p += 1
                continue
            n = length
            while p + n < len(words) and q + n < len(phrases[source]) and words[p + n] == phrases[source][q + n]:
                n += 1
            out.append((k, p, n, d))
            p += n - length + 1
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_factors_are_greedy(seed):
    rng = random.Random(seed)
    pool = [[rng.randrange(3) for _ in range(30)] for _ in range(4)]
    phrases = []
    for _ in range(40):
        p = rng.choice(pool)
        a = rng.randrange(12)
        phrases.append(p[a:a + rng.randint(6, 18)] + [rng.randrange(3) for _ in range(rng.randrange(4))])
    docs = [rng.randrange(12) for _ in phrases]
    words = np.array([w for p in phrases for w in p], np.uint64)
    ref = factors.Reference(words, np.array([len(p) for p in phrases]), np.array(docs), length=5)
    place, size, source = factors.parse(ref)
    row = ref.phrase[place]
    got = sorted(zip(row.tolist(), (place - ref.start[row]).tolist(), size.tolist(), ref.doc[source].tolist()))
    want = greedy(phrases, docs, 5)
    assert got == want and any(n > 5 for _, _, n, _ in want)


def test_no_phrases_have_no_factors():
    ref = factors.Reference(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))
    assert [len(c) for c in factors.parse(ref)] == [0, 0, 0]


@pytest.mark.parametrize("case", CASES)
def test_passage_in_every_document(ready, monkeypatch, case):
    """One passage between different words in all documents: its strings fill
    several ranges, and are compared across their boundaries."""
    run, n, units, length, join = CASES[case]
    monkeypatch.setattr(repeats, "GROUP", 16)
    rng = random.Random(4)
    passage = " ".join(f"p{i * 7 % 31}q{i}" for i in range(24))
    rows = [(i, f"{' '.join(f'{rng.random():.9f}' for _ in range(6))} {passage} {rng.random():.9f} tail{i % 9}")
            for i in rng.sample(range(5000), 400)]
    df = ready.createDataFrame(rows, "doc_id bigint, text string").repartition(6)
    got = run(df).select("doc_id", n, "n_removed", "n_spans", "kept_sha256").collect()
    assert sorted([tuple(r) for r in got], key=repr) == brute(rows, units, length, join)


def test_only_unknown_windows_are_compared_across_tasks(ready):
    """Of a spread block, the windows that an earlier document of the same task has
    are settled; the others get the earlier document of another task."""
    reps = pa.table({"anchor": [1, 1], "block": [10, 11], "ord": [4, 6]})
    row, at = np.array([0, 0, 1, 1, 1]), np.array([0, 1, 0, 1, 2])
    d = np.array([1, 2, 1, 2, 3], np.uint64)
    got = repeats.resolved_rows(reps, row, at, [d, d], np.array([4, 4, 4, 4, 6]), np.array([True, True])).to_pydict()
    assert list(zip(got["block"], got["at"], got["n"], got["first"], got["open"], got["d1"])) == [
        (10, 0, 1, 4, True, 1), (10, 1, 1, 4, True, 2), (11, 0, 2, 4, False, 0), (11, 2, 1, 6, True, 3)]
    there = {k: [*v, x] for (k, v), x in zip(got.items(), (1, 12, 0, 1, 5, True, 3, 3))}  # another task: document 5 has window 3
    runs = ready.createDataFrame(list(zip(*there.values())), repeats.RESOLVED)
    extra = [tuple(r) for r in repeats.settle(runs).collect()]
    assert sorted(extra) == [(1, 10, 0, 1, 4), (1, 10, 1, 1, 4), (1, 11, 0, 2, 4), (1, 11, 2, 1, 5), (1, 11, 2, 1, 6), (1, 12, 0, 1, 5)]
