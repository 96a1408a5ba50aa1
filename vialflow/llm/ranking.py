"""Ranked lexical search by the Best Position Algorithm.

An item's terms ask for the documents with the highest sums of impacts. The
impact of a term in a document is

    w * ((10**9 * tf) div (1000 * tf + 8 * m)),  m = 25 + (75 * n * N) div L

with w = floor(1000 * ln((2 N + 2) / (2 df + 1))), all counts over the whole
table. Documents are dealt into shards of bounded size; a shard holds an impact
list per term, highest first, and the same postings by document for direct
access. Per item a shard

* reads the next places of every list, a run of places at a time, starting
  behind the list's *best position* (the last place up to which all are seen);
* takes the full score of each document met there by direct access, which also
  tells the document's place in all other lists of the item and marks it seen,
  so best positions move on without reading;
* stops when the sum of the impacts at the best positions, which no unseen
  document can exceed, lies strictly below the k-th best score, so that ties
  with it are complete.

Runs double from round to round: at most as many places again are read as were
needed. The shards' winners are merged by a window that keeps k rows per item
before and after the shuffle.

Only postings of asked terms are kept, and items are taken in blocks
(``TERMS`` terms each), so what goes to every task is bounded; each block is one
reading of the documents. Document frequencies, N and L are one aggregate.

Defined cases: a NULL text has no terms; an item without terms, or whose terms
no document holds, gives no rows; rows that repeat an item's id and text are one
item; repeated document rows are ranked each; ties go to the smaller document id
(NULL ids last); empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vialflow.llm.common import materialise, prepare, read, register, scratch

K = 10
#: Distinct terms of the items answered in one reading of the documents.
TERMS = 50_000
#: Postings and documents of a shard.
POSTINGS, DOCUMENTS = 1_500_000, 16_384
#: Places read from each list in an item's first round.
RUN = 32
_OUT = "_item bigint, doc_id bigint, score bigint"

#: ASCII but digits and letters parts terms; A-Z are lower-cased.
_TERM_BYTES = bytes(b | 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms(text: str | None) -> list[bytes]:
    """Terms of a text, in order and with repeats, as UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_TERM_BYTES).split()


def _postings(vocabulary):
    """(id, text) batches to (id, length, term numbers, counts)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.value
        for batch in batches:
            sizes, term, tf = [], [], []
            for text in batch.column(1):
                words = terms(text.as_py())
                got = Counter(words)
                mine = sorted((known[t], got[t]) for t in got.keys() & known.keys())
                sizes.append(len(words))
                term.append([t for t, _ in mine])
                tf.append([c for _, c in mine])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(term, pa.list_(pa.int32())), pa.array(tf, pa.list_(pa.int32()))],
                ["id", "n", "term", "tf"])
    return run


def weight(n_docs: int, df: np.ndarray) -> np.ndarray:
    """floor(1000 * ln((2 N + 2) / (2 df + 1)))."""
    return np.floor(1000 * np.log((2 * n_docs + 2) / (2 * df + 1))).astype(np.int64)


class Shard:
    """Impact lists of a shard's documents, and their postings by document."""

    def __init__(self, ids: list, n: np.ndarray, ends: np.ndarray, term: np.ndarray, tf: np.ndarray,
                 n_docs: int, n_terms: int, weights: np.ndarray):
        # documents in the order of ties: position in the shard stands for the id
        order = np.array(sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0)), np.int64)
        self.ids = [ids[i] for i in order]
        starts, sizes = (ends - np.diff(ends, prepend=0))[order], np.diff(ends, prepend=0)[order]
        self.start = np.concatenate([[0], np.cumsum(sizes)])
        at = np.repeat(starts - self.start[:-1], sizes) + np.arange(self.start[-1])
        self.term, tf = term[at].astype(np.int64), tf[at].astype(np.int64)
        doc = np.repeat(np.arange(len(order)), sizes)
        m = 25 + (75 * n[order] * n_docs) // max(n_terms, 1)
        self.impact = weights[self.term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[doc]))
        # lists: by term, falling impact, then document
        sort = np.lexsort((doc, -self.impact, self.term))
        self.list_start = np.searchsorted(self.term[sort], np.arange(len(weights) + 1))
        self.list_doc, self.list_impact = doc[sort], self.impact[sort]
        self.place = np.empty(len(sort), np.int64)  # of each posting in the list of its term
        self.place[sort] = np.arange(len(sort)) - self.list_start[self.term[sort]]
        self.number = np.full(len(weights), -1, np.int64)  # of a term in the item at hand

    def _access(self, docs: np.ndarray):
        """Direct access: (which of ``docs``, term of the item, place, impact)."""
        sizes = self.start[docs + 1] - self.start[docs]
        ends = np.cumsum(sizes)
        at = np.repeat(self.start[docs] - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)
        number = self.number[self.term[at]]
        mine = number >= 0
        at = at[mine]
        return np.repeat(np.arange(len(docs)), sizes)[mine], number[mine], self.place[at], self.impact[at]

    def best(self, asked: np.ndarray, times: np.ndarray, k: int, run: int = RUN) -> tuple[np.ndarray, np.ndarray, int]:
        """The k best (document positions, scores) for the terms ``asked``,
        each ``times`` over, and the number of places read."""
        held = self.list_start[asked + 1] > self.list_start[asked]
        asked, times = asked[held], times[held]
        low, size = self.list_start[asked], self.list_start[asked + 1] - self.list_start[asked]
        if not len(asked):
            return np.zeros(0, np.int64), np.zeros(0, np.int64), 0
        self.number[asked] = np.arange(len(asked))
        first = np.concatenate([[0], np.cumsum(size)])  # of each list in ``seen``
        seen = np.zeros(first[-1], bool)
        met = np.zeros(len(self.ids), bool)
        position = np.zeros(len(asked), np.int64)  # places from the front that are all seen
        best_doc, best_score, reads = np.zeros(0, np.int64), np.zeros(0, np.int64), 0
        while True:
            spans = [slice(low[i] + position[i], low[i] + min(position[i] + run, size[i])) for i in range(len(asked))]
            docs = np.concatenate([self.list_doc[s] for s in spans])
            reads += len(docs)
            docs = np.unique(docs[~met[docs]])
            met[docs] = True
            row, number, place, impact = self._access(docs)
            seen[first[number] + place] = True
            score = np.zeros(len(docs), np.int64)
            np.add.at(score, row, impact * times[number])
            best_doc, best_score = np.concatenate([best_doc, docs]), np.concatenate([best_score, score])
            keep = np.lexsort((best_doc, -best_score))[:k]
            best_doc, best_score = best_doc[keep], best_score[keep]
            bound = 0
            for i in range(len(asked)):
                rest = seen[first[i] + position[i]:first[i + 1]]
                gap = int(rest.argmin()) if len(rest) else 0
                position[i] += len(rest) if len(rest) and rest[gap] else gap
                if position[i] < size[i]:
                    # nothing unseen in this list lies above its best position
                    bound += int(times[i]) * int(self.list_impact[low[i] + max(position[i] - 1, 0)])
            if (position == size).all() or (len(best_doc) == k and bound < best_score[-1]):
                break
            run *= 2
        self.number[asked] = -1
        good = best_score > 0
        return best_doc[good], best_score[good], reads


def _searcher(asked, weights, n_docs: int, n_terms: int, k: int):
    """One partition of postings is a shard; it answers all items."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, parts = [], []
        for b in batches:
            ids += b.column(0).to_pylist()
            lists = b.column(2)
            parts.append((b.column(1).to_numpy(), lists.value_lengths().to_numpy(), lists.flatten().to_numpy(),
                          b.column(3).flatten().to_numpy()))
        if not ids:
            return
        n, sizes, term, tf = (np.concatenate(c) for c in zip(*parts))
        parts.clear()
        shard = Shard(ids, n.astype(np.int64), np.cumsum(sizes, dtype=np.int64), term, tf, n_docs, n_terms, weights.value)
        out: list[list] = [[], [], []]
        for key, numbers, times in asked.value:
            docs, scores, _ = shard.best(numbers, times, k)
            out[0] += [key] * len(docs)
            out[1] += [shard.ids[d] for d in docs]
            out[2] += scores.tolist()
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], ["_item", "doc_id", "score"])
    return run


def _blocks(items: DataFrame) -> Iterator[list]:
    """The items in blocks of bounded vocabulary, one block at a time."""
    block, vocabulary = [], set()
    for r in items.toLocalIterator():
        words = Counter(terms(r["text"]))
        if block and len(vocabulary | words.keys()) > TERMS:
            yield block
            block, vocabulary = [], set()
        block.append((r["key"], words))
        vocabulary |= words.keys()
    if block:
        yield block


def rank(docs: DataFrame, items: DataFrame, k: int = K, id_col: str = "doc_id", text_col: str = "text",
         item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """``item_id, rank, doc_id, score``: the k best documents of each item."""
    spark = docs.sparkSession
    sc = spark.sparkContext
    items = (items.select(F.col(item_col).alias("item_id"), F.col(item_text).alias("text")).where("text is not null")
             .distinct().withColumn("key", F.monotonically_increasing_id()))
    items = materialise(items, "ranking-items")
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    found = []
    for block in _blocks(items):
        words = {t: i for i, t in enumerate(sorted({t for _, w in block for t in w}))}
        if not words:
            continue
        sent = sc.broadcast(words)
        rows = materialise(texts.mapInArrow(_postings(sent), "id bigint, n bigint, term array<int>, tf array<int>")
                           .where("n > 0"), "ranking-postings")
        size = rows.agg(F.count(F.lit(1)), F.sum("n"), F.sum(F.size("term"))).first()
        n_docs, n_terms, n_postings = size[0], size[1] or 0, size[2] or 0
        df = np.zeros(len(words), np.int64)  # one entry per asked term
        for r in rows.select(F.explode("term").alias("t")).groupBy("t").count().toLocalIterator():
            df[r["t"]] = r["count"]
        asked = sc.broadcast([(key, np.array([words[t] for t in w], np.int64), np.array(list(w.values()), np.int64))
                              for key, w in block if w])
        shards = max(1, -(-n_postings // POSTINGS), -(-n_docs // DOCUMENTS))
        search = _searcher(asked, sc.broadcast(weight(n_docs, df)), n_docs, n_terms, k)
        path = scratch(spark, "ranking-found")
        rows.where(F.size("term") > 0).repartition(shards).mapInArrow(search, _OUT).write.parquet(path)
        found.append(path)
    if not found:
        return spark.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    order = Window.partitionBy("_item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return (spark.read.schema(_OUT).parquet(*found).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .join(items.select(F.col("key").alias("_item"), "item_id"), "_item").select("item_id", "rank", "doc_id", "score"))


@register("op12_best_position_search", """
with q as (
  select row_number() over () as key, item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') as t
  from (select distinct item_id, text from benchmark where text is not null)),
a as (select key, unnest(t) as term from q),
asked as (select key, term, count(*) as times from a group by all),
d as (
  select row_number() over () as doc, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') as t
  from documents where text is not null),
size as (select count(*) as N, sum(len(t)) as L from d where len(t) > 0),
p as (select doc, term, count(*) as tf from (select doc, unnest(t) as term from d) group by all),
df as (select term, floor(1000 * ln((2 * N + 2) / (2 * count(*) + 1)))::bigint as w from p, size group by term, N),
m as (select doc, doc_id, 100 - 75 + (75 * len(t) * N) // L as m from d, size where len(t) > 0),
scored as (
  select key, doc, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::bigint as score
  from asked join p using (term) join df using (term) join m using (doc) group by all),
best as (
  select item_id, cast(row_number() over (partition by key order by score desc, doc_id) as int) as rank, doc_id, score
  from scored join q using (key) join m using (doc) where score > 0)
select * from best where rank <= 10
""")
def op12_best_position_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten best documents of every benchmark item."""
    prepare(spark)
    return rank(read(spark, sf_dir, "documents").select("doc_id", "text"),
                read(spark, sf_dir, "benchmark").select("item_id", "text"))
