"""The pipeline stage by stage against brute force, on a whole small table."""

from collections import Counter, defaultdict

import duckdb
import numpy as np
from pyspark.sql import functions as F
from test_operators import WORD_BPE, brute_groups, waterfill, words

import corpus_pipeline
from vialflow.llm import tokens
from vialflow.llm.queries import ORACLE

SF = "/root/testdata/sf0.001"


def cut(rows):
    """Texts without bytes that repeat 50-byte strings of smaller ids."""
    first = {}
    for i, t in rows:
        b = t.encode()
        for p in range(len(b) - 49):
            k = b[p:p + 50]
            first[k] = min(first.get(k, i), i)
    out = {}
    for i, t in rows:
        b = t.encode()
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - 49):
            if first[b[p:p + 50]] < i:
                gone[p:p + 50] = True
        out[i] = bytes(np.frombuffer(b, np.uint8)[~gone]).decode(errors="ignore")
    return out


def test_stages_against_brute_force(ready):
    from vialflow.llm.common import materialise
    docs = ready.read.parquet(f"{SF}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_copies", "passages", "mixing", "packing"]
    done = {}
    for name, stage in corpus_pipeline.STAGES:
        columns = docs.columns
        docs = done[name] = materialise(stage(ready, docs, SF), f"t-{name}")
        assert name == "packing" or docs.columns == columns
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    sql = ORACLE["op1_quality_rules"]
    kept = {r[0] for r in con.execute(f"select doc_id from ({sql}) where kept").fetchall()}
    text = dict(con.execute("select doc_id, text from documents").fetchall())
    source = dict(con.execute("select doc_id, source from documents").fetchall())
    assert {r["doc_id"] for r in done["quality"].collect()} == kept and 0 < len(kept) < len(text)

    groups = brute_groups([(i, text[i]) for i in sorted(kept)])
    kept = {i for i, _, _, stays in groups if stays}
    assert {r["doc_id"] for r in done["near_copies"].collect()} == kept and len(kept) < len(groups)

    want = cut([(i, text[i]) for i in kept])
    got = {r["doc_id"]: r["text"] for r in done["passages"].collect()}
    assert got == want and want != {i: text[i] for i in kept}
    assert done["passages"].where(F.length("text") != F.col("n_chars")).count() == 0

    sizes = Counter()
    for i, t in want.items():
        sizes[source[i]] += len(words(t))
    target = waterfill(sizes, {s: k % 3 + 1 for k, s in enumerate(sorted(sizes))})
    rows = [(r["doc_id"], r["text"]) for r in done["mixing"].collect()]
    taken, copies = Counter(), Counter()
    for i, t in rows:
        assert t == want[i]
        taken[source[i]] += len(words(t))
        copies[i] += 1
    assert max(copies.values()) <= 3
    largest = defaultdict(int)
    for i, t in want.items():
        largest[source[i]] = max(largest[source[i]], len(words(t)))
    assert all(abs(taken[s] - target[s]) <= largest[s] for s in sizes)

    enc = tokens.Encoder(WORD_BPE, 2)
    pieces = done["packing"].collect()
    by_doc = Counter()
    for p in pieces:
        by_doc[p["doc_id"]] += p["length"]
    assert by_doc == Counter({i: (len(enc.encode([want[i]])[0]) // 2 + 1) * c for i, c in copies.items()})
    fill = Counter()
    for p in pieces:
        fill[p["sequence_id"]] += p["length"]
    assert sorted(fill.values())[1:] == [4096] * (len(fill) - 1)


def test_run_is_the_stages(ready):
    a = corpus_pipeline.run(ready, SF).drop("ids").collect()
    b = corpus_pipeline.run(ready, SF).drop("ids").collect()
    assert a and sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_odd_tables(ready, tmp_path, documents, nothing):
    labels = ready.createDataFrame([(1, 1, 0), (2, None, None)], "doc_id long, quality int, toxic int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    for df in (documents, nothing):
        docs = df
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(ready, docs, str(tmp_path))
            assert docs.columns == df.columns
        assert (corpus_pipeline.STAGES[-1][1](ready, docs, str(tmp_path)).count() == 0) == (df is nothing)
