"""Line features, forward-backward and held-out quality."""

import itertools
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from vialflow.llm import linecrf, linefeatures
from vialflow.llm.queries import QUERIES


def chain(score, step):
    """Marginals, pair marginals and log Z of one text, over all labellings."""
    n = len(score)
    paths = list(itertools.product((0, 1), repeat=n))
    w = np.array([np.exp(sum(score[i] * p[i] for i in range(n)) + sum(step[a, b] for a, b in zip(p, p[1:]))) for p in paths])
    z = w.sum()
    good = [sum(v for v, p in zip(w, paths) if p[i]) / z for i in range(n)]
    pair = [[[sum(v for v, p in zip(w, paths) if p[i] == a and p[i + 1] == b) / z for b in (0, 1)] for a in (0, 1)]
            for i in range(n - 1)]
    return good, pair, np.log(z)


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(1)
    n_lines = np.array([1, 5, 2, 9, 1, 7])
    score, step = rng.normal(0, 3, n_lines.sum()), rng.normal(0, 2, (2, 2))
    good, pair, here, log_z = linecrf.forward_backward(score, step, n_lines)
    want = [chain(s, step) for s in np.split(score, np.cumsum(n_lines)[:-1])]
    assert np.allclose(good, np.concatenate([w[0] for w in want]))
    assert np.allclose(pair, np.concatenate([np.array(w[1]).reshape(-1, 2, 2) for w in want]))
    assert np.allclose(log_z, [w[2] for w in want]) and len(here) == (n_lines - 1).sum()


def test_long_chains_stay_finite():
    n = np.array([200_000, 1])
    good, _, _, log_z = linecrf.forward_backward(np.tile([50.0, -50.0], 100_001)[:n.sum()], np.array([[3.0, -3], [-3, 3]]), n)
    assert np.isfinite(good).all() and np.isfinite(log_z).all() and good[0] > 0.99 and good[1] < 0.01


def test_gradient_equals_differences():
    rng = np.random.default_rng(2)
    numbers, size, n_lines = linefeatures.emissions([b"one two\nthree | four", b"", b"A!! B!!\nA!! B!!\n\nx"])
    label = np.array([1, 0, 0])
    w = rng.normal(0, 0.3, linecrf._WIDTH)
    model = lambda v: linecrf.Model(np.zeros(linefeatures.N_ALL), np.ones(linefeatures.N_ALL), v)
    got = model(w).likelihood(numbers, size, n_lines, label)
    for i in range(len(w)):
        e = np.zeros(len(w))
        e[i] = 1e-5
        up, down = (model(w + d).likelihood(numbers, size, n_lines, label)[0] for d in (e, -e))
        assert got[1 + i] == pytest.approx((up - down) / 2e-5, abs=1e-5)


def test_minimise_a_bent_valley():
    f = lambda x: ((1 - x[0]) ** 2 + 20 * (x[1] - x[0] ** 2) ** 2,
                   np.array([-2 * (1 - x[0]) - 80 * x[0] * (x[1] - x[0] ** 2), 40 * (x[1] - x[0] ** 2)]))
    assert np.allclose(linecrf.minimise(f, np.array([-1.0, 1.0]), 300), [1, 1], atol=1e-2)


def test_features_do_not_depend_on_the_batch():
    rng = random.Random(3)
    texts = [" ".join(rng.choice(["aa", "b!", "|", "É", "12", "\n", "the"]) for _ in range(rng.randrange(40))).encode() for _ in range(60)]
    texts += [b"", b"\n\n", b" \t ", b"x" * 3000, b"the the the the the the"]
    together, size, n_lines = linefeatures.emissions(texts)
    assert n_lines.tolist() == [t.count(b"\n") + 1 for t in texts]
    alone = [linefeatures.emissions([t]) for t in texts]
    assert np.allclose(together, np.concatenate([a[0] for a in alone]))
    assert size.tolist() == [len(x) for t in texts for x in t.split(b"\n")]
    assert sum(map(len, linefeatures.chunks(texts * 300))) == 300 * len(texts)


def test_held_out_documents_are_told_apart(spark):
    sf = "/root/testdata/sf0.1"
    df = QUERIES["op13_line_crf"](spark, sf)
    assert df.dtypes == [("doc_id", "bigint"), ("held_out", "boolean"), ("score", "double"), ("predicted", "int")]
    rows = df.collect()
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3)
    test = [(r["score"], labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    bad, good = [s for s, q in test if q == 0], [s for s, q in test if q == 1]
    assert np.mean([(g > b) + (g == b) / 2 for g in good for b in bad]) > 0.99
    assert np.mean([s < 0.3 for s in bad]) > 0.95 and np.mean([s >= 0.3 for s in good]) > 0.98


def test_odd_rows(ready, documents, clashing, nothing):
    labels = [(1, 1), (3, 1), (4, 0), (5, 0), (6, 0), (9, 1), (11, 0), (12, 0), (13, 1), (19, 1), (18, 1), (14, 0), (15, 0),
              (2, 0), (2, 1), (8, None), (8, 1), (None, 1)]
    lab = ready.createDataFrame(labels, "doc_id long, quality int")
    model = linecrf.fit(clashing, lab.withColumns({c: F.lit("extra") for c in ("label", "_most", "text", "size")}))
    assert isinstance(model, linecrf.Model)
    got = linecrf.score(clashing, model).collect()
    assert len(got) == documents.count() and all(0 <= r["score"] <= 1 for r in got)
    key = lambda r: (r["_id"] or 0, r["score"])
    again = sorted(linecrf.score(documents.repartition(3), model).collect(), key=key)
    assert np.allclose([key(r) for r in sorted(got, key=key)], [key(r) for r in again])
    by_id = {r["_id"]: r["score"] for r in got}
    assert by_id[4] == pytest.approx(by_id[5])  # NULL is empty
    assert linecrf.score(nothing, model).collect() == []


def test_without_usable_labels(documents, ready):
    lab = ready.createDataFrame([(1, 1), (3, 1), (2, None)], "doc_id long, quality int")
    assert linecrf.fit(documents, lab) == 1.0 and linecrf.fit(documents, lab.where("1 = 0")) == 0.5
    assert {r["score"] for r in linecrf.score(documents, 0.5).collect()} == {0.5}
