"""The other operators against brute force, exact round trips and odd rows."""

import random
import zlib
from collections import Counter, defaultdict
from fractions import Fraction
from math import comb, log10

import numpy as np
import public_tokenizers
import pytest
from llm_fixtures import rows_of
from pyspark.sql import functions as F

from vialflow.llm import idstore, mixing, neardup, ngrams, packing, quality, toolcalls, tokens, topk
from vialflow.llm.common import NULL_ID, id_order, scratch
from vialflow.llm.components import components

WORD_BPE, BYTE_BPE = (public_tokenizers.path(f) for f in ("word_bpe_49k.json", "byte_bpe_50k.json"))


def words(t):
    return (t or "").encode().split()


# -- quality ----------------------------------------------------------------

def test_binomial_tail_is_exact(ready):
    cases = [(n, k) for n in (1, 7, 200, 3000) for k in (0, 1, 3, 14, 40) if k <= n]
    p = Fraction(5, 1000)
    df = ready.createDataFrame(cases, "n long, k long")
    got = df.select("n", "k", quality.binomial_lower_tail(F.col("n"), F.col("k"), 0.005).alias("p")).collect()
    for r in got:
        exact = float(sum(comb(r["n"], j) * p ** j * (1 - p) ** (r["n"] - j) for j in range(r["k"] + 1)))
        assert r["p"] == pytest.approx(exact if r["k"] < r["n"] * 0.005 else 1.0, rel=1e-9)


def brute_measures(t):
    t = t or ""
    w = [x.decode() for x in words(t)]
    grams = Counter(zip(w, w[1:], w[2:]))
    at = {i + k for i, g in enumerate(zip(w, w[1:], w[2:])) if grams[g] > 1 for k in range(3)}
    lines = [x for x in t.split("\n") if words(x)]
    return (len(w), len("".join(w)), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(at))


def test_measures(documents, clashing, nothing):
    cols = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    for df in (documents, clashing):
        got = [tuple(r) for r in quality.measure(df).orderBy("n").select(*cols).collect()]
        assert got == [brute_measures(t) for _, t in rows_of(documents)]
    assert quality.measure(nothing).collect() == []


def test_cutoffs_hold_and_filter(ready):
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(4000):
        bad = i % 4 == 0
        text = " ".join(f"w{rng.randrange(10 ** 6)}" + ("%%%" if bad else "") for _ in range(60))
        rows.append((i, text, "en" if i // 4 % 2 else None))
        labels.append((i, 0 if bad else 1))
    labels += [(1, 0), (2, None)]  # disagreeing and NULL labels do not count
    docs = ready.createDataFrame(rows, "doc_id long, text string, lang string")
    lab = ready.createDataFrame(labels, "doc_id long, quality int")
    m = quality.measure(docs)
    cuts = {r["stratum"]: r for r in quality.calibrate(m, lab, alpha=0.08).collect()}
    assert set(cuts) == {"en", None} and all(c["cut_symbols"] is not None and c["cut_capitals"] is None for c in cuts.values())
    kept = quality.judge(m, quality.calibrate(m, lab, alpha=0.08)).where("kept").count()
    assert kept == 3000
    few = quality.calibrate(m, lab.limit(40), alpha=0.02)
    assert all(c["cut_symbols"] is None for c in few.collect())  # too few labels prove nothing
    assert quality.keep_good(docs.where("1 = 0"), lab).collect() == []


# -- mixing -----------------------------------------------------------------

def waterfill(sizes, weights, cap=3):
    left, out = set(sizes), {}
    total = sum(sizes.values())
    while left:
        w = sum(weights[s] for s in left)
        room = total - sum(out.values())
        full = [s for s in left if room * weights[s] / w > cap * sizes[s]]
        if not full:
            return out | {s: room * weights[s] / w for s in left}
        for s in full:
            out[s] = cap * sizes[s]
            left.discard(s)
    return out


@pytest.mark.parametrize("group", [2048, 4])
def test_mix(ready, documents, group):
    rng = random.Random(2)
    rows = [(i, "w " * rng.randrange(0, 80), rng.choice(["a", "b", "é", "Z", None] + ["hot"] * 3)) for i in range(900)]
    rows += [(i, "w " * 5, "tiny") for i in range(900, 903)]
    docs = ready.createDataFrame(rows, "doc_id long, text string, source string")
    m = mixing.mix(docs, group=group).collect()
    assert len(m) == len(rows)
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len(words(t))
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None]
    want = waterfill(sizes, {s: i % 3 + 1 for i, s in enumerate(order)})
    taken = Counter()
    for r in m:
        taken[r["source"]] += r["taken"]
        assert r["target"] == pytest.approx(want[r["source"]]) and r["source_size"] == sizes[r["source"]]
        assert 0 <= r["taken"] <= 3 * r["size"] and r["size"] == len(words(r["text"]))
    assert all(abs(taken[s] - want[s]) <= 1 for s in sizes)
    again = mixing.mix(docs.repartition(7), group=group).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, m))


def test_mix_is_fair(ready):
    """Over many seeds, each document is taken as often as its source's ratio says."""
    docs = ready.createDataFrame([(i, "w " * (1 + i), "a" if i < 6 else "b") for i in range(12)],
                                 "doc_id long, text string, source string").cache()
    runs = [mixing.mix(docs, seed=s, group=3).collect() for s in range(25)]
    for rows in runs:
        for r in rows:
            assert r["taken"] in range(3 * r["size"] + 1)
    mean = sum(r["taken"] / r["target"] for rows in runs for r in rows) / len(runs)
    assert mean == pytest.approx(2.0, abs=0.05)


def test_mix_odd_rows(documents, clashing, nothing):
    assert mixing.mix(nothing).collect() == []
    assert len(mixing.mix(clashing).collect()) == documents.count()
    repeated = mixing.repeat_rows(documents)
    assert repeated.columns == documents.columns
    copies = Counter(r["n"] for r in repeated.collect())
    assert copies and max(copies.values()) <= 3


# -- tokens, packing, id store ----------------------------------------------

@pytest.mark.parametrize("path", [WORD_BPE, BYTE_BPE])
def test_tokens_equal_the_library(documents, path):
    enc = tokens.Encoder(path, 2)
    texts = [t or "" for _, t in rows_of(documents)]
    texts += [" lead", "trail ", "a  b", "a \n b", "x,y.", "don't, can't.", "it's.,", "Ünï, cödé.\nÉ", "1,000.5 ,", "٣, ²,", "İstanbul ǅ ﬁ",
              "á b", "\x85x", "a b c", "w" * 100 + " " + "w" * 100 + ".", "<|startoftext|> x", "ſ K Å", "a%%% b!! c_d e_ f's g's. x--y \"q\" (z) 12% 3.5$ ½% ²!\nNew.\nÉtat\nit's\n12 A\n\nB"]
    rng = random.Random(1)
    texts += ["".join(rng.choice("ab é.,'\n \tZ9_ß|") for _ in range(60)) for _ in range(300)]
    want = [np.array(enc.tok.encode(t, add_special_tokens=False).ids, "<u2").tobytes() for t in texts]
    assert enc.spell is not None
    assert enc.encode(texts) == want and enc.encode(texts) == want


def test_hilbert_neighbours():
    for dims, bits in ((2, 4), (3, 3), (4, 2)):
        side = 1 << bits
        cells = np.stack(np.meshgrid(*[np.arange(side)] * dims, indexing="ij"), -1).reshape(-1, dims)
        key = packing.hilbert_key(cells, bits)
        assert sorted(key) == list(range(side ** dims))
        path = cells[np.argsort(key)]
        assert (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()


def check_pieces(rows, pieces, max_tokens, enc, end):
    want = Counter()
    for i, t in rows:
        want[i, enc.encode([t or ""])[0] + end] += 1
    got = Counter()
    by_seq = defaultdict(list)
    for p in sorted(pieces, key=lambda p: (p["sequence_id"], p["offset"])):
        by_seq[p["sequence_id"]].append(p)
        assert len(p["ids"]) == 4 * p["length"] > 0
    fill = []
    line = []
    for seq in sorted(by_seq):
        at = 0
        for p in by_seq[seq]:
            assert p["offset"] == at
            at += p["length"]
            line.append(p)
        fill.append(at)
    assert all(f == max_tokens for f in fill[:-1]) and (not fill or fill[-1] <= max_tokens)
    open_docs = {}
    for p in line:  # pieces of a document follow each other
        k = (p["doc_id"], p["doc_tokens"])
        ids, done = open_docs.pop(k, (b"", 0)) if p["start"] else (b"", 0)
        assert p["start"] == done
        ids, done = ids + p["ids"], done + p["length"]
        if done == p["doc_tokens"]:
            got[p["doc_id"], np.frombuffer(ids, "<u4").astype("<u2").tobytes()] += 1
        else:
            open_docs[k] = (ids, done)
    assert got == want and not open_docs


def test_pack(documents, clashing, nothing):
    enc = tokens.Encoder(WORD_BPE, 2)
    end = np.array([2], "<u2").tobytes()
    for df, size in ((documents, 4096), (clashing, 64)):
        check_pieces(rows_of(documents), packing.pack(df, WORD_BPE, 2, max_tokens=size).collect(), size, enc, end)
    assert packing.pack(nothing, WORD_BPE, 2).collect() == []


def test_neighbours_are_packed_together(ready):
    """Two vocabularies: along the curve, sequences hold mostly one of them."""
    rng = random.Random(3)
    topics = [[f"alpha{i}" for i in range(30)], [f"omega{i}" for i in range(30)]]
    rows = [(i, " ".join(rng.choice(topics[i % 2]) for _ in range(40))) for i in range(200)]
    pieces = packing.pack(ready.createDataFrame(rows, "doc_id long, text string"), WORD_BPE, 2, max_tokens=1024).collect()
    share = defaultdict(Counter)
    for p in pieces:
        share[p["sequence_id"]][p["doc_id"] % 2] += p["length"]
    assert sum(max(c.values()) for c in share.values()) > 0.8 * sum(sum(c.values()) for c in share.values())


def test_store_round_trip(ready, documents, nothing):
    enc = tokens.Encoder(BYTE_BPE, 2)
    rows = rows_of(documents)
    path = scratch(ready, "t-shards")
    idstore.write_shards(documents, path, BYTE_BPE, 0)
    store = idstore.Store(ready, path)
    ids = [(NULL_ID if i is None else i, enc.encode([t or ""])[0] + b"\0\0") for i, t in rows]
    wide = lambda b: np.frombuffer(b, "<u2").astype("<u4").tobytes()
    keys = documents.select(id_order("doc_id").alias("key")).union(ready.createDataFrame([(777,)], "key long"))
    got = Counter((r["key"], bytes(r["ids"])) for r in store.fetch(keys).collect())
    assert got == Counter((i, wide(b)) for i, b in ids)
    some = store.fetch(keys.where("key = 1")).collect()
    assert len(some) == 2 and store.fetch(keys.where("key = 777")).collect() == []
    read = store.read_all(keys).orderBy("start").collect()
    at = 0
    for r in read:
        assert r["start"] == at
        at += r["n_tokens"]
    assert Counter((r["key"], r["n_tokens"], r["ids_crc32"]) for r in read) == Counter(
        (i, len(b) // 2, zlib.crc32(wide(b))) for i, b in ids)
    assert [r["key"] for r in read] == sorted(i for i, _ in ids)
    empty = scratch(ready, "t-empty")
    idstore.write_shards(nothing, empty, BYTE_BPE, 0)
    assert idstore.Store(ready, empty).read_all(keys).collect() == []


def test_perfect_hash_is_minimal():
    rng = np.random.default_rng(0)
    for n in (1, 2, 3, 50, 2048):
        h = rng.integers(0, 1 << 63, n).astype(np.uint64)
        disp, slot = idstore.displacements(h)
        assert sorted(slot) == list(range(n)) and (idstore.slots_of(h, disp, n) == slot).all()


# -- language model ---------------------------------------------------------

@pytest.mark.parametrize("bounds", [{}, {"table_words": 40, "filter_entries": 2000}])
def test_lm_base_is_exact(documents, bounds):
    full, model = ngrams.train(documents, **bounds)
    got = sorted([tuple(r) for r in ngrams.score(documents, full, model).drop("score").collect()], key=repr)
    rows = rows_of(documents)
    out_of = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0
    toks = [[*words((t or "").encode().lower().decode()), None] for _, t in rows]
    c = Counter(w for (i, _), ws in zip(rows, toks) if not out_of(i) for w in ws)
    n, v = sum(c.values()), len(c)
    want = sorted([(i, out_of(i), len(ws), sum(c[w] > 0 for w in ws), n,
                    sum(log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws)) for (i, _), ws in zip(rows, toks)], key=repr)
    for g, w in zip(got, want):
        assert g[:5] == w[:5] and g[5] == pytest.approx(w[5], abs=1e-6)


def test_lm_helps_on_held_out_texts(ready):
    rng = random.Random(5)
    after = {f"w{i}": [f"w{rng.randrange(60)}" for _ in range(3)] for i in range(60)}
    rows = []
    for i in range(400):
        w = ["w0"]
        for _ in range(80):
            w.append(rng.choice(after[w[-1]]))
        rows.append((i, " ".join(w)))
    docs = ready.createDataFrame(rows, "doc_id long, text string")
    full, model = ngrams.train(docs)
    held = ngrams.score(docs, full, model).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert held[0] > held[1] * 0.6  # three followers a word: far better than words alone
    assert ngrams.score(docs.where("1 = 0"), full, model).collect() == []


def test_lm_score_is_the_same_at_any_size(ready):
    """Words outside the table and a filter that is not broadcast change the way, not the score."""
    rng = random.Random(6)
    # w50 .. w299 are rare, yet have pairs that occur twice or more
    rows = [(i, " ".join(f"w{min(rng.randrange(300), rng.randrange(300))} then w{rng.randrange(300)}"
                         for _ in range(rng.randint(0, 60)))) for i in range(300)]
    docs = ready.createDataFrame(rows, "doc_id long, text string").repartition(3)
    toks = {i: [None, *t.split(), "</s>"] for i, t in rows}
    out_of = lambda i: zlib.crc32(str(i).encode()) % 10 == 0
    train = [t for i, t in toks.items() if not out_of(i)]
    c = Counter(w for t in train for w in t[1:])
    pairs = Counter(p for t in train for p in zip(t, t[1:]))
    stored = {p: 2.0 ** int(np.log2(k)) for p, k in pairs.items() if k >= 2}
    mass = Counter()
    for (h, _), q in stored.items():
        mass[h] += q
    n, v = sum(c.values()), len(c)
    times = {**c, None: len(train)}

    def p(h, w):
        rest = max(times.get(h, 0) - mass[h], 0) + 10.0
        return (stored.get((h, w), 0.0) + rest * (c[w] + 0.1) / (n + 0.1 * (v + 1))) / (times.get(h, 0) + 10.0)

    want = {i: sum(log10(p(h, w)) for h, w in zip(t, t[1:])) for i, t in toks.items()}
    got = []
    for bounds in ({}, {"table_words": 40}, {"filter_entries": 100}, {"table_words": 40, "filter_entries": 100}):
        full, model = ngrams.train(docs, **bounds)
        got.append({r["doc_id"]: r["score"] for r in ngrams.score(docs, full, model).collect()})
        assert got[-1] == pytest.approx(got[0], abs=1e-9)
        assert (model["least"] > 1) == ("table_words" in bounds) and (model["bits"] is None) == ("filter_entries" in bounds)
    # false positives of the filter only
    assert sum(abs(got[0][i] - want[i]) for i in want) < 0.02 * sum(abs(s) for s in want.values())


def test_lm_writes_rows_for_held_pairs_only(ready, monkeypatch):
    """A filter that is not broadcast leaves no pair open; words outside the table
    leave the pairs that the filter holds. The end of a text may be such a word."""
    rng = random.Random(7)
    texts = [" ".join(f"w{min(rng.randrange(400), rng.randrange(400))}" for _ in range(2000)) for _ in range(4)]
    texts[3] += " never seen words at the end"
    ids = [i for i in range(50) if zlib.crc32(str(i).encode()) % 10][:3] + [i for i in range(50) if zlib.crc32(str(i).encode()) % 10 == 0][:1]
    docs = ready.createDataFrame(list(zip(ids, texts)), "doc_id long, text string")
    written = {}
    plain = ngrams.materialise
    monkeypatch.setattr(ngrams, "materialise", lambda df, name: written.setdefault(name, plain(df, name)))
    got, pairs = [], []
    for bounds in ({}, {"filter_entries": 100}, {"table_words": 100, "filter_entries": 100}):
        written.clear()
        full, model = ngrams.train(docs, **bounds)
        got.append({r["doc_id"]: r["score"] for r in ngrams.score(docs, full, model).collect()})
        pairs.append(written["lm-scored"].agg(F.sum(F.size("p_ctx"))).first()[0])
        assert got[-1] == pytest.approx(got[0], abs=1e-9)
    assert model["least"] > 3  # the end, three times in training, is outside the table
    assert pairs[:2] == [0, 0] and 0 < pairs[2] < 0.5 * sum(len(t.split()) for t in texts)


def test_filter_reads_back_levels(ready):
    rows = [(5, i, 1 + i % 6) for i in range(5000)]
    deal, fill = ngrams._build(3)
    df = ready.createDataFrame(rows, "ctx long, word long, level int")
    out = np.zeros((3, ngrams.BLOCK), np.uint8)
    for r in df.mapInArrow(deal, "block long, key long, level int").groupBy("block").applyInArrow(
            fill, "block long, bytes binary").collect():
        out[r["block"]] = np.frombuffer(r["bytes"], np.uint8)
    key = lambda a: ngrams.chain([np.full(len(a), 5, np.uint64), a.astype(np.uint64)])
    got = ngrams.read_level(out.reshape(-1), 3, key(np.arange(5000)))
    assert (got >= [r[2] for r in rows]).all() and (got == [r[2] for r in rows]).mean() > 0.97
    assert (ngrams.read_level(out.reshape(-1), 3, key(np.arange(10 ** 6, 10 ** 6 + 5000))) > 0).mean() < 0.03


# -- near duplicates --------------------------------------------------------

def shingle_set(t):
    w = words((t or "").encode().translate(bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))).decode())
    return {tuple(w[i:i + 3]) for i in range(len(w) - 2)} if len(w) >= 3 else {tuple(w)} if w else set()


def brute_groups(rows):
    sets = [shingle_set(t) for _, t in rows]
    ids = [NULL_ID if i is None else i for i, _ in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= 85 * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    least = {}
    for x in range(len(rows)):
        least[find(x)] = min(least.get(find(x), 1 << 62), ids[x])
    out = [(rows[x][0], len(sets[x]), None if least[find(x)] == NULL_ID else least[find(x)], ids[x] == least[find(x)])
           for x in range(len(rows))]
    return sorted(out, key=repr)


def near_rows(df):
    r = neardup.near_duplicates(df).select("doc_id", "n_shingles", "component_id", "kept")
    return sorted([tuple(x) for x in r.collect()], key=repr)


@pytest.mark.parametrize("chunk", [512, 5])
def test_near_duplicate_families(ready, monkeypatch, chunk):
    """Families around the threshold: some copies link only through others."""
    monkeypatch.setattr(neardup, "CHUNK", chunk)
    rng = random.Random(chunk)
    rows = []
    for f in range(4):
        base = [f"f{f}w{rng.randrange(400)}" for _ in range(150)]
        for _ in range(40):
            w = list(base)
            for _ in range(rng.randint(0, 9)):
                w[rng.randrange(len(w))] = f"x{rng.randrange(10 ** 6)}"
            rows.append((len(rows) * 7 % 1001, " ".join(w)))
    df = ready.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want = brute_groups(rows)
    assert near_rows(df) == want and 4 < sum(r[3] for r in want) < 160


def test_near_duplicates_odd_rows(documents, clashing, nothing):
    want = brute_groups(rows_of(documents))
    assert near_rows(documents) == want and near_rows(clashing) == want
    assert near_rows(nothing) == []
    kept = neardup.keep_first(documents)
    assert kept.columns == documents.columns
    left = [r["doc_id"] for r in kept.collect()]
    assert left.count(1) == 1 and 2 not in left and 16 not in left and None in left


def test_components_of_a_long_path(ready):
    rng = random.Random(1)
    nodes = rng.sample(range(10 ** 6), 300)
    links = [(a, b) for a, b in zip(nodes, nodes[1:])] + [(5 * 10 ** 6, 6 * 10 ** 6)]
    got = {r["node"]: r["root"] for r in components(ready.createDataFrame(links, "a long, b long")).collect()}
    assert all(got[n] == min(nodes) for n in nodes) and got[6 * 10 ** 6] == 5 * 10 ** 6


# -- tool calls -------------------------------------------------------------

def test_tool_calls(ready):
    calls = ready.createDataFrame([
        (1, "a", 5, "search", '{"limit": 3, "query": "q\\u00e9"}', ["b"]), (1, "b", 6, "search", '{"query":"x","limit":1.0}', None),
        (1, "c", 1, "search", '{"query":"x","limit":"3"}', []), (1, "d", 2, "nope", "{}", None), (1, "e", 3, "search", "[1]", None),
        (1, "f", 4, "search", '{"query":"x","limit":1}', ["f"]), (1, "g", 7, "search", '{"query":"x","limit":1}', ["zz"]),
        (1, "b", 9, "search", "{}", None), (1, "b", 9, "search", "{}", None), (1, None, 1, "search", "{}", None),
        (None, "a", 1, "search", "{}", None), (2, "h", 1, "search", '{"query":"x"}', ["i"]), (2, "i", 1, "search", None, ["h"]),
        (2, "j", 1, "search", '{"query":"x","limit":1,"more":{}}', None),
    ], "conv_id long, call_id string, seq long, name string, arguments string, after array<string>")
    results = ready.createDataFrame([(1, "a", 7, "late"), (1, "a", 6, "found"), (1, "b", 8, None), (3, "a", 1, "lost"),
                                     (None, "b", 4, "x"), (1, None, 3, "y"), (1, None, 3, "y")],
                                    "conv_id long, call_id string, seq long, content string")
    schemas = ready.createDataFrame([("search", "query", "string", True), ("search", "limit", "integer", True)],
                                    "name string, parameter string, type string, required boolean")
    got = {(r["conv_id"], r["call_id"], r["seq"]): r for r in toolcalls.link(calls, results, schemas).collect()}
    status = {k: r["status"] for k, r in got.items()}
    assert status == {
        (1, "a", 5): "ok", (1, "b", 6): "ok", (1, "c", 1): "bad_arguments", (1, "d", 2): "unknown_tool",
        (1, "e", 3): "bad_arguments", (1, "f", 4): "cycle", (1, "g", 7): "missing_dependency", (1, "b", 9): "repeated_id",
        (1, None, 1): "no_id", (None, "a", 1): "no_id", (2, "h", 1): "cycle", (2, "i", 1): "cycle", (2, "j", 1): "bad_arguments",
        (3, "a", 1): "orphan_result", (None, "b", 4): "orphan_result", (1, None, 3): "orphan_result"}
    extra = {c: F.lit("extra") for c in ("level", "status", "args", "before", "floor", "far", "_b")}
    again = toolcalls.link(calls.withColumns(extra), results.withColumns(extra), schemas.withColumns({"kind": F.lit(1), "args": F.lit(1)}))
    assert sorted(map(repr, again.collect())) == sorted(map(repr, got.values()))
    order = sorted((r["position"], k[1]) for k, r in got.items() if k[0] == 1 and r["position"] is not None)
    assert order == [(0, "c"), (1, "d"), (2, "e"), (3, "b"), (4, "g"), (5, "a")]
    assert got[1, "a", 5]["line"] == '{"after":["b"],"arguments":{"limit":3,"query":"qé"},"id":"a","name":"search","result":"found"}'
    none = calls.where("1 = 0")
    assert [r["status"] for r in toolcalls.link(none, results, schemas).collect()] == ["orphan_result"] * 5
    assert toolcalls.link(none, results.where("1 = 0"), schemas).collect() == []


def brute_levels(ids, waits):
    need = {c: {b for a, b in waits if a == c} for c in ids}
    level = {}
    while True:
        ready_now = [c for c in need if c not in level and need[c] <= level.keys()]
        if not ready_now:
            return level
        for c in ready_now:
            level[c] = max((level[b] + 1 for b in need[c]), default=0)


def test_levels_of_random_graphs(ready):
    rng = random.Random(6)
    ids, waits = [], []
    for conv in range(12):
        n = rng.randrange(1, 40)
        ids += [(conv, f"c{i}") for i in range(n)]
        for i in range(1, n):
            many = rng.choice([0, 1, 1, 1, 1, 2, 3])
            waits += [((conv, f"c{i}"), (conv, f"c{rng.randrange(max(0, i - 4), i)}")) for _ in range(many)]
        if conv % 4 == 0 and n > 6:  # a circle, and what hangs on it
            waits += [((conv, "c1"), (conv, "c3")), ((conv, "c3"), (conv, "c1"))]
    calls = ready.createDataFrame(ids, "conv_id long, call_id string")
    rows = ready.createDataFrame([(*a, b[1]) for a, b in waits], "conv_id long, call_id string, before string")
    got = {(r["conv_id"], r["call_id"]): r["level"] for r in toolcalls.levels(calls, rows).collect()}
    assert got == brute_levels(ids, set(waits))


def test_a_chain_of_a_thousand_calls_takes_few_rounds(ready, monkeypatch):
    n, written = 1000, []
    table = toolcalls.materialise
    monkeypatch.setattr(toolcalls, "materialise", lambda df, name: written.append(name) or table(df, name))
    calls = ready.range(n).select(F.lit(1).alias("conv_id"), F.format_string("c%d", "id").alias("call_id"), "id")
    waits = calls.where("id > 0").select("conv_id", "call_id", F.format_string("c%d", F.col("id") - 1).alias("before"))
    got = {r["call_id"]: r["level"] for r in toolcalls.levels(calls, waits).collect()}
    assert got == {f"c{i}": i for i in range(n)} and written.count("calls-links") <= 12


def test_long_arguments(ready):
    big = "x" * 300_000
    calls = ready.createDataFrame([(1, "a", 0, "t", '{"q":"' + big + '"}', None)],
                                  "conv_id long, call_id string, seq long, name string, arguments string, after array<string>")
    results = ready.createDataFrame([(1, "a", 1, big)], "conv_id long, call_id string, seq long, content string")
    schemas = ready.createDataFrame([("t", "q", "string", True)], "name string, parameter string, type string, required boolean")
    (row,) = toolcalls.link(calls, results, schemas).collect()
    assert row["status"] == "ok" and row["line"].count("x") == 600_000


# -- top-k ------------------------------------------------------------------

def test_top_k_odd_vectors(ready, monkeypatch):
    monkeypatch.setattr(topk, "CANDIDATES_PER_BLOCK", 7)
    monkeypatch.setattr(topk, "QUERIES_PER_BLOCK", 2)
    rng = random.Random(0)
    rows = [(i, [rng.choice([-0.5, 0.0, 0.25, 0.5]) for _ in range(4)]) for i in range(60)]
    rows += [(100, None), (101, [float("nan")] * 4), (102, [1.0, None, 0.0, 0.0]), (103, [float("inf"), 0.0, 0.0, 0.0]), (None, [0.5] * 4),
             (104, []), (105, [2.0 ** 30, 2.0 ** 30, 0.0, 0.0]), (106, [0.5, 0.5]), (5, rows[5][1])]
    df = ready.createDataFrame(rows, "vec_id long, embedding array<double>")
    ask = df.where("vec_id % 5 = 0")
    got = sorted(tuple(r) for r in topk.top_k(df, ask, k=6).collect())
    ok = [(i, [int(np.floor(1024 * x)) for x in v]) for i, v in rows
          if v and all(x is not None and np.isfinite(x) for x in v)]
    want = []
    for q, v in {(q, tuple(v)) for q, v in ok if q is not None and q % 5 == 0}:
        s = sorted((-sum(a * b for a, b in zip(v, c)), 1 << 62 if i is None else i, i) for i, c in ok if i != q)[:6]
        want += [(q, k + 1, i, -x) for k, (x, _, i) in enumerate(s)]
    assert got == sorted(want)
    assert topk.top_k(df.where("1 = 0"), ask.where("1 = 0")).collect() == []
