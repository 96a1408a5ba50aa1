"""Hand-checked frames and invariants from the source material."""

import math

from pyspark.sql import functions as F

from vialflow.functions import scalar as S
from vialflow.functions import text as T
from vialflow.operators import features as FE
from vialflow.operators import window as W


def test_molar_mass_examples(spark):
    df = spark.createDataFrame([("CO2",), ("H2O",), ("C6H12O6",), ("XeF2",), ("Ca(OH)2",)], "f string")
    got = {r.f: (r.m, r.e) for r in df.select("f", S.molar_mass("f").alias("m"), S.formula_error("f").alias("e")).collect()}
    assert math.isclose(got["CO2"][0], 12.011 + 2 * 15.999)
    assert math.isclose(got["H2O"][0], 2 * 1.008 + 15.999)
    assert math.isclose(got["C6H12O6"][0], 6 * 12.011 + 12 * 1.008 + 6 * 15.999)
    assert got["XeF2"] == (None, "unknown element: Xe, F")
    assert got["Ca(OH)2"] == (None, "unparsed")


def test_ph_and_quantity(spark):
    df = spark.createDataFrame([(2.5,), (7.0,), (8.1,), (6.9,), (7.3,)], "ph double")
    assert [r[0] for r in df.select(S.classify_reading("ph")).collect()] == \
        ["acidic", "neutral", "basic", "acidic", "basic"]
    q = spark.createDataFrame([("25C",), ("298K",)], "t string").select(S.parse_quantity("t").alias("q"))
    assert [r.q.kelvin for r in q.collect()] == [298.15, 298.0]


def test_wells_row_major(spark):
    df = spark.range(200).withColumnRenamed("id", "i")
    w = W.assign_wells(df, ["i"], block=F.floor(F.col("i") / 37)).orderBy("i").collect()
    assert [w[k].well for k in (0, 11, 12, 95)] == ["A1", "A12", "B1", "H12"]
    assert w[96].plate == 2 and w[96].well == "A1"
    assert [r.idx for r in w] == list(range(200))


def test_running_blocks_equal_plain_window(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("g"), F.col("id").alias("o"),
                                  ((F.col("id") * 37) % 101).cast("double").alias("v"))
    a = W.running(df, ["o"], {"s": ("sum", "v"), "m": ("max", "v")}, ["g"])
    b = W.running(df, ["o"], {"s": ("sum", "v"), "m": ("max", "v")}, ["g"], block=F.floor(F.col("o") / 50))
    assert sorted(a.collect()) == sorted(b.collect())


def test_split_is_partition_independent(spark):
    df = spark.range(5000).withColumnRenamed("id", "k")
    one = FE.split(df.repartition(1), "k", 0.7, 3).collect()
    many = FE.split(df.repartition(13), "k", 0.7, 3).collect()
    assert sorted(one) == sorted(many)
    share = sum(1 for r in one if r.split == "train") / len(one)
    assert 0.65 < share < 0.75


def test_stratified_split_quota(spark):
    df = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") % 10 == 0).cast("int").alias("y"))
    s = FE.split_stratified(df, "k", "y", 0.8, 1).groupBy("y", "split").count().collect()
    c = {(r.y, r.split): r["count"] for r in s}
    assert c[(1, "train")] == 80 and c[(0, "train")] == 720


def test_parse_label_rules(spark):
    df = spark.createDataFrame([("Note: unclear\nYes\nRationale: fits",), ("N\nbecause",), ("",)], "t string")
    got = [tuple(r.p) for r in df.select(T.parse_label("t").alias("p")).collect()]
    assert got == [("Y", "fits"), ("N", "because"), ("", "")]


def test_tanimoto_prefix_filter_matches_brute_force(spark):
    """The prefix-filtered join finds exactly the brute-force pairs."""
    import itertools
    import re

    import __spark_entry__ as E
    sf = "/root/testdata/sf0.001"
    rows = E.queries()["tanimoto_pairs"](spark, sf).collect()
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    sets = {i: {w for w in re.split(r"[^\w]+|_", t.lower()) if w} for i, t in docs}
    want = {}
    for (a, sa), (b, sb) in itertools.combinations(sorted(sets.items()), 2):
        if sa and sb:
            j = len(sa & sb) / len(sa | sb)
            if j >= 0.8:
                want[(a, b)] = j
    # copies are linked to their smallest id, different sets paired by it
    same = {r.b: r.a for r in rows if sets[r.a] == sets[r.b]}
    assert same == {b: min(i for i in sets if sets[i] == sets[b]) for b in sets
                    if sets[b] and any(i < b and sets[i] == sets[b] for i in sets)}
    members = {}
    for i in sets:
        members.setdefault(same.get(i, i), []).append(i)
    got = {tuple(sorted((x, y))): 1.0 for m in members.values() for x, y in itertools.combinations(m, 2) if sets[m[0]]}
    for r in rows:
        if sets[r.a] != sets[r.b]:
            got |= {tuple(sorted((x, y))): r.jaccard for x in members[r.a] for y in members[r.b]}
    assert set(got) == set(want)
    assert all(abs(got[k] - want[k]) < 1e-8 for k in want)


def test_gp_interpolates_observations(spark):
    from vialflow.operators.planning import gp_score
    obs = spark.createDataFrame([(0.0, 0.1), (0.25, 0.4), (0.5, 0.9), (0.75, 0.3), (1.0, 0.2)], "x double, y double")
    cand = obs.select(F.monotonically_increasing_id().alias("id"), "x")
    got = gp_score(obs, cand, ["x"], "y", "id", noise=1e-8).join(cand, "id").orderBy("x").collect()
    assert [round(r.mu, 4) for r in got] == [0.1, 0.4, 0.9, 0.3, 0.2]
    assert all(r.sigma < 1e-3 for r in got)


def test_pareto_demo_front(spark):
    """14-point two-objective example: 5 points on the front."""
    from vialflow.operators.planning import pareto_2d
    pts = [(0.2, 0.9), (0.6, 0.6), (0.9, 0.2), (0.5, 0.8), (0.5, 0.5), (0.4, 0.7), (0.7, 0.3), (0.8, 0.4),
           (0.3, 0.3), (0.2, 0.5), (0.6, 0.5), (0.4, 0.3), (0.3, 0.2), (0.3, 0.5)]
    df = spark.createDataFrame(pts, "a double, b double")
    front = sorted((r.a, r.b) for r in pareto_2d(df, "a", "b").where("on_front").collect())
    assert front == [(0.2, 0.9), (0.5, 0.8), (0.6, 0.6), (0.8, 0.4), (0.9, 0.2)]


def test_same_answer_at_any_partition_count(spark):
    """Results do not depend on the shuffle partition count."""
    import __spark_entry__ as E
    sf = "/root/testdata/sf0.001"
    names = ["general_condition", "sort_rank", "assign_wells", "split_stratified", "pareto_front", "roc_curve"]
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        results = []
        for n in ("1", "4", "32"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            results.append({q: sorted(map(tuple, E.queries()[q](spark, sf).collect())) for q in names})
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert results[0] == results[1] == results[2]


def test_find_sections_at_any_depth(spark):
    from vialflow.functions import text as T
    leaf = '{"TOCHeading": "Key six", "Information": [{"Value": {"StringWithMarkup": [{"String": " six "}, {"String": ""}]}}]}'
    record = leaf
    for i in (5, 4, 3, 2, 1):
        own = f'"Information": [{{"Value": {{"StringWithMarkup": [{{"String": "line {i}"}}]}}}}]'
        record = f'{{"Title": "Key {i}", {own}, "Section": [{record}, {{"Title": "other"}}]}}'
    rows = [(1, f'{{"Record": {{"Section": [{record}]}}}}'), (2, "no json"), (3, None), (4, '{"Record": {}}')]
    df = spark.createDataFrame(rows, "id int, js string")
    got = {r["title"]: (r["order"], r["path"], r["text"], r["n_lines"]) for r in T.find_sections(df, "id", "js", "key", 2).collect()}
    assert got["Key six"] == ("0.0.0.0.0.0", " > Key 1 > Key 2 > Key 3 > Key 4 > Key 5 > Key six", "six", 1)
    assert got["Key 1"] == ("0", " > Key 1", "line 1\nline 2", 6) and len(got) == 6
    assert T.find_sections(df.where("id > 1"), "id", "js", "key").collect() == []


def test_nearest_row_has_no_bound_on_proposals(spark):
    from vialflow.operators.joins import nearest_row
    pool = [(i, float(i * 37 % 101), float(i * 53 % 97)) for i in range(20)]
    # 10,001 were refused before; 20,001 are met in blocks instead of a broadcast
    for n in (10_001, 20_001):
        props = spark.range(n).select("id", (F.col("id") * 7 % 101).cast("double").alias("x"),
                                      (F.col("id") * 11 % 97).cast("double").alias("y"))
        got = nearest_row(props, spark.createDataFrame(pool, "k int, x double, y double"), ["x", "y"], "id", "k").collect()
        assert len(got) == n
        for r in got:
            x, y = r["id"] * 7 % 101, r["id"] * 11 % 97
            d2, k = min(((a - x) ** 2 + (b - y) ** 2, k) for k, a, b in pool)
            assert r["k"] == k and math.isclose(r["distance"], math.sqrt(d2))


def test_untested_parts_are_met_by_every_line(spark, tmp_path):
    """A part is untested only if no line of the whole table holds it."""
    import __spark_entry__ as E
    spark.createDataFrame([(k,) for k in (1, 2, 3)], "p_partkey long").write.parquet(f"{tmp_path}/part.parquet")
    spark.createDataFrame([(1, 0.1, 0.0), (2, 0.05, 0.08)], "l_partkey long, l_discount double, l_tax double").write.parquet(
        f"{tmp_path}/lineitem.parquet")
    assert [r.p_partkey for r in E.queries()["untested"](spark, str(tmp_path)).collect()] == [3]


def test_late_matches_make_no_candidates(spark):
    """Sets that only share tokens too far behind make no rows; near copies do."""
    from vialflow.operators.similarity import _candidates
    apart = [(i, [-1] * 4 + list(range(16 * (i % 2), 16 * (i % 2) + 16))) for i in range(60)]
    near = [(100 + i, [*range(1000, 1018), 2000 + i, 3000 + i]) for i in range(5)]
    got = _candidates(spark.createDataFrame(apart + near, "_id long, _s array<bigint>"), 0.8).collect()
    assert {(r.a, r.b) for r in got} == {(a, b) for a in range(100, 105) for b in range(a + 1, 105)} and len(got) == 10
    assert {(r.na, r.nb) for r in got} == {(20, 20)}


def test_similar_sets_of_random_sizes(spark):
    """All pairs by brute force, also where sizes differ by the whole allowed factor."""
    import random

    from vialflow.operators.similarity import tanimoto_pairs
    rng = random.Random(5)
    sets = {}
    for i in range(0, 300, 3):
        base = [f"w{rng.randrange(60)}" for _ in range(rng.choice((1, 3, 4, 5, 8, 10, 20, 40)))]
        sets |= {i: set(base), i + 1: set(base[:-1] or base), i + 2: set(base) | {f"w{rng.randrange(60)}"}}
    for t in (0.5, 0.8, 1.0):
        got = {(r.a, r.b): r.jaccard for r in tanimoto_pairs(
            spark.createDataFrame([(i, sorted(s)) for i, s in sets.items()], "id long, s array<string>"), "id", "s", t).collect()}
        rep = {i: min(j for j in sets if sets[j] == s) for i, s in sets.items()}
        ids = sorted(set(rep.values()))
        want = {(a, b): len(sets[a] & sets[b]) / len(sets[a] | sets[b]) for a in ids for b in ids if a < b}
        want = {k: v for k, v in want.items() if v >= t} | {(r, i): 1.0 for i, r in rep.items() if i != r}
        assert got == want


def _ranked_by_hand(questions, chunks, k):
    """Top k by TF-IDF cosine: tokens of rows with one id count together."""
    import re
    from collections import Counter, defaultdict
    from math import log, sqrt
    cut = lambda t: [w for w in re.split(r"[^a-z0-9]+", (t or "").lower()) if w]
    docs = defaultdict(Counter)
    for i, t in chunks:
        docs[i].update(cut(t))
    df = Counter(w for d in docs.values() for w in d)
    idf = {w: log((1 + len(chunks)) / (1 + c)) + 1 for w, c in df.items()}
    unit = lambda c: {w: x * idf[w] / sqrt(sum((y * idf[v]) ** 2 for v, y in c.items())) for w, x in c.items()}
    vecs = {i: unit(d) for i, d in docs.items() if d}
    out = {}
    for q, t in questions:
        v = unit({w: c for w, c in Counter(cut(t)).items() if w in idf})
        s = {i: round(sum(x * d[w] for w, x in v.items() if w in d), 9) for i, d in vecs.items() if v.keys() & d.keys()}
        out[q] = sorted(((-x, (i is not None, i)) for i, x in s.items()))[:k]
    return {q: [(i[1], -x) for x, i in best] for q, best in out.items() if best}


def test_retrieval_shuffles_counts_of_words_only(spark, monkeypatch):
    """Also where most words are not broadcast, with repeated and NULL ids, NULL
    texts, copies that tie, and questions in several passes."""
    import random

    import pytest

    from vialflow.operators import similarity as L
    rng = random.Random(3)
    word = lambda: f"w{int(rng.paretovariate(0.6)) % 900}"
    chunks = [(i, " ".join(word() for _ in range(rng.randint(1, 50)))) for i in range(600)]
    chunks += [(1000 + i, chunks[7][1]) for i in range(40)] + [(3, "w1 more of w2"), (3, "w5 w5"), (None, "w9 w8"), (2000, None), (2001, "")]
    questions = [(q, " ".join(word() for _ in range(30))) for q in range(9)] + [(20, chunks[7][1]), (21, "unheard"), (22, None)]
    c = spark.createDataFrame(chunks, "id long, body string").repartition(5)
    q = spark.createDataFrame(questions, "q long, ask string")
    want = _ranked_by_hand(questions, chunks, 3)
    tables = []
    plain = L.written
    monkeypatch.setattr(L, "written", lambda df, name: tables.append(plain(df, name)) or tables[-1])
    batch = "spark.sql.execution.arrow.maxRecordsPerBatch"
    for known, asked, size in ((1 << 17, 1 << 20, 10_000), (20, 60, 10)):
        monkeypatch.setattr(L, "KNOWN_WORDS", known, raising=False)
        monkeypatch.setattr(L, "ASKED_WORDS", asked, raising=False)
        spark.conf.set(batch, size)  # several batches: thresholds leave light words out
        tables.clear()
        got = {}
        for r in L.retrieve(q, "q", "ask", c, ["id"], "body", 3).orderBy("q", "rank").collect():
            got.setdefault(r.q, []).append((r.id, r.score))
        assert {x: [i for i, _ in y] for x, y in got.items()} == {x: [i for i, _ in y] for x, y in want.items()}
        assert all(a[1] == pytest.approx(b[1], abs=2e-9) for x in want for a, b in zip(got[x], want[x]))
        # a table may hold a row per word or per chunk, never one per word of a chunk
        assert max(t.count() for t in tables) <= 900
    spark.conf.unset(batch)


def test_context_makes_no_row_per_word_of_a_chunk(spark, monkeypatch):
    """The whole job, from the tables: no written table outgrows chunks and words."""
    import __spark_entry__ as E

    from vialflow.operators import similarity as L
    from vialflow.plans import similarity as P
    sf = "/root/testdata/sf0.001"
    tables = []
    plain = L.written
    for module in (L, P):
        monkeypatch.setattr(module, "written", lambda df, name: tables.append(plain(df, name)) or tables[-1])
    got = E.queries()["build_context"](spark, sf).collect()
    chunks = P._chunks(spark, sf)
    words = chunks.select(F.explode(L.tokenize_words("text")).alias("w")).distinct().count()
    questions = spark.read.parquet(f"{sf}/benchmark.parquet").count()
    assert len(got) == questions and all(len(r.sources) == 3 for r in got)
    assert max(t.count() for t in tables) <= max(chunks.count(), words, 50 * questions)


def test_long_sets_need_several_shared_tokens(spark):
    """Unrelated long sets that share a few rare tokens make no candidates; pairs at the threshold do."""
    from vialflow.operators.similarity import _candidates
    few = [(i, [0, 1, 2] + list(range(1000 * i, 1000 * i + 400))) for i in range(1, 30)]
    # 360 of 400 tokens shared, the others rarer: J = 360 / 440 > 0.8
    near = [(100 + i, [*range(50_000 + 100 * i, 50_040 + 100 * i), *range(60_000, 60_360)]) for i in range(3)]
    got = _candidates(spark.createDataFrame(few + near, "_id long, _s array<bigint>"), 0.8).collect()
    assert {(r.a, r.b) for r in got} == {(100, 101), (100, 102), (101, 102)} and len(got) == 3


def test_similar_long_sets_in_groups(spark, monkeypatch):
    """All pairs by brute force, sets of 40 to 400 tokens, most tokens without a rank,
    neighbourhoods dealt to several groups."""
    import random

    from vialflow.operators import jaccard
    from vialflow.operators.similarity import tanimoto_pairs
    rng = random.Random(8)
    sets = {}
    for c in range(12):
        base = {f"w{min(rng.randrange(5000), rng.randrange(5000))}" for _ in range(rng.choice((40, 90, 200, 400)))}
        for _ in range(rng.randint(1, 14)):
            kept = {w for w in base if rng.random() > 0.07}
            sets[len(sets)] = kept | {f"w{rng.randrange(5000)}" for _ in range(rng.randrange(1 + len(base) // 12))}
    sets[len(sets)] = set(sets[3])
    monkeypatch.setattr(jaccard, "KNOWN_WORDS", 100)
    monkeypatch.setattr(jaccard, "GROUP_TOKENS", 4000)
    df = spark.createDataFrame([(i, sorted(s)) for i, s in sets.items()] + [(None, sorted(sets[0])), (999, None), (998, [])],
                               "id long, s array<string>")
    got = {(r.a, r.b): r.jaccard for r in tanimoto_pairs(df, "id", "s", 0.8).collect()}
    rep = {i: min(j for j in sets if sets[j] == s) for i, s in sets.items()}
    ids = sorted(set(rep.values()))
    want = {(a, b): len(sets[a] & sets[b]) / len(sets[a] | sets[b]) for a in ids for b in ids if a < b}
    want = {k: v for k, v in want.items() if v >= 0.8}
    assert len(want) > 30
    assert got == want | {(r, i): 1.0 for i, r in rep.items() if i != r}


def test_search_and_pairs_of_empty_tables(spark):
    from vialflow.operators.similarity import retrieve, tanimoto_pairs
    q = spark.createDataFrame([(1, "some words"), (2, None)], "q long, ask string")
    c = spark.createDataFrame([("a", 1, "other things"), ("b", None, None), (None, 2, "")], "d string, n int, body string")
    found = lambda x, y: retrieve(x, "q", "ask", y, ["d", "n"], "body", 2).collect()
    assert found(q, c) == found(q, c.where("false")) == found(q.where("false"), c) == []
    hit = c.unionByName(spark.createDataFrame([("z", None, "words, WORDS")], c.schema))
    assert [(r.q, r.d, r.n, r.rank) for r in found(q, hit)] == [(1, "z", None, 1)]
    sets = spark.createDataFrame([("x", ["u", "v"]), ("y", ["v", "u", "u"]), ("w", []), (None, ["u"])], "id string, s array<string>")
    assert [tuple(r) for r in tanimoto_pairs(sets, "id", "s", 0.8).collect()] == [("x", "y", 1.0)]
    assert tanimoto_pairs(sets.where("false"), "id", "s", 0.8).collect() == []
