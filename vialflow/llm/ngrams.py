"""Language-model scores from a log-frequency Bloom filter.

Training counts words and word pairs of the documents whose
crc32(id) mod 10 is not 0. A pair's count is quantised to
``floor * 2 ** (level - 1)`` and the filter holds the pair once per level up
to its own; a reader probes level after level until one is missing and so
recovers the quantised count. The model interpolates with the base model
p0(w) = (c(w) + 0.1) / (N + 0.1 (V + 1)):

    p(w | h) = (q(h, w) + (c(h) - Q(h) + MU) * p0(w)) / (c(h) + MU)

with q the quantised count and Q(h) its sum over the pairs stored for h, so
what quantising and the floor leave out goes to the base model and the
probabilities of a context sum to one (but for false positives).

Sizes. The model is the same at any size: the filter holds every pair that
occurs ``FLOOR`` times or more, whatever its context, and grows with the
corpus; counts of words are exact. Only the way to it differs:

* The most frequent words, ``TABLE_WORDS`` at most, are broadcast. A token
  whose word and context are among them is scored on the spot. Elsewhere

      log p(w | h) = log p0(w) + log a(h) + log(1 + q / (A(h) p0(w))),
      A(h) = c(h) - Q(h) + MU,  a(h) = A(h) / (c(h) + MU),

  so a word outside the table is joined with its counts once per document, for
  the first two terms, and only pairs that the filter holds become rows.
* A filter of up to ``FILTER_ENTRIES`` entries is broadcast. A larger one is
  written as a table of blocks and copied, block by block, into a file that
  every executor gets once (``addFile``) and its workers map: 1.25 bytes an entry
  of disk, no worker's heap and no row per pair. The bits are the same, and so
  are the scores.

Defined cases: a NULL text is empty (only the end token); a NULL id counts as
the empty text under crc32, so its document is held out; repeated rows are
scored each and all count in training; without training tokens the counts are
zero, V is 0 and the base is log10(0.1 / 0.1) per token; an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vialflow.llm.common import materialise, prepare, read, register, tasks_for, text_of
from vialflow.llm.repeats import chain, word_units

#: Words and filter entries that are broadcast; more words are joined, a larger filter is mapped.
TABLE_WORDS = 1 << 22
FILTER_ENTRIES = 1 << 26
#: Pairs that occur less often are left to the base model, at any size.
FLOOR = 2
BITS_PER_ENTRY, PROBES = 10, 5
#: Bytes of one block of the filter: all probes of an n-gram stay in one.
BLOCK = 1 << 16
MU = 10.0
ALPHA = 0.1
#: Codes beside the words' 64-bit hashes: single words, document start and end.
UNIGRAM, START, END = 0, 1, 2
_U = np.uint64
_BATCH_TOKENS = 1 << 22


def held_out(id_col: str = "doc_id") -> Column:
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 10 == 0


def _tokens(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens, their contexts and the token count of each text."""
    units = [word_units(t.encode().lower()) for t in texts]
    sizes = np.array([len(u) + 1 for u in units], np.int64)
    stops = np.cumsum(sizes)
    words = np.empty(int(sizes.sum()), _U)
    for u, stop in zip(units, stops):
        words[stop - 1 - len(u):stop - 1] = u
    words[stops - 1] = END
    before = np.empty_like(words)
    before[1:] = words[:-1]
    before[stops - sizes] = START
    return words, before, sizes


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(ctx, word, n) of words and pairs, one row per batch of tokens."""
    def rows(texts):
        words, before, _ = _tokens(texts)
        one, n = np.unique(words, return_counts=True)
        yield np.full(len(one), UNIGRAM, _U), one, n
        # pairs of one context side by side: it compresses in the shuffle; a pair cut in two is summed there
        order = np.argsort(before & _U(0xFFFFFFFF << 32) | chain([before, words]) >> _U(32))
        a, b = before[order], words[order]
        head = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
        yield a[head], b[head], np.diff(np.r_[head, len(a)])

    def emit(texts):
        for ctx, word, n in rows(texts):
            for at in range(0, len(n), 1 << 18):
                cut = slice(at, at + (1 << 18))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ctx[cut].view(np.int64)), pa.array(word[cut].view(np.int64)), pa.array(n[cut].astype(np.int64))],
                    ["ctx", "word", "n"])

    texts, size = [], 0
    for batch in batches:
        for t in batch.column("text"):
            texts.append(t.as_py())
            size += len(texts[-1]) // 5 + 1
            if size >= _BATCH_TOKENS:
                yield from emit(texts)
                texts, size = [], 0
    if texts:
        yield from emit(texts)


def count_ngrams(train: DataFrame) -> DataFrame:
    """``ctx, word, c``: all words, and the pairs that occur twice or more."""
    rows = train.select(text_of("text").alias("text")).mapInArrow(_count, "ctx bigint, word bigint, n bigint")
    # counted per batch of tokens already, so the rows are dealt out once
    rows = rows.repartition(tasks_for(train), "ctx", "word").groupBy("ctx", "word").agg(F.sum("n").alias("c"))
    return materialise(rows.where((F.col("ctx") == UNIGRAM) | (F.col("c") >= FLOOR)), "lm-counts")


def _levels(c: Column, floor: int) -> Column:
    """Highest level of a count: floor * 2 ** (level - 1) <= c."""
    return (F.floor(F.log2(c / floor) + 1e-12) + 1).cast("int")


def probes(key: np.ndarray, level: int, bits: int) -> list[np.ndarray]:
    """Bits of an n-gram's level within its block."""
    a = chain([key], 0x51ED2701 + level)
    b = a >> _U(32) | _U(1)
    return [((a + b * _U(i)) & _U(0xFFFFFFFF)) % _U(bits) for i in range(PROBES)]


def block_of(key: np.ndarray, blocks: int) -> np.ndarray:
    return (chain([key], 0xB10C) % _U(blocks)).astype(np.int64)


def _build(blocks: int):
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ctx, word = (batch.column(c).to_numpy().view(_U) for c in ("ctx", "word"))
            key = chain([ctx, word])
            yield pa.RecordBatch.from_arrays(
                [pa.array(block_of(key, blocks)), pa.array(key.view(np.int64)), batch.column("level")], ["block", "key", "level"])

    def fill(rows: pa.Table) -> pa.Table:
        key, top = rows.column("key").to_numpy().view(_U), rows.column("level").to_numpy()
        bits = np.zeros(BLOCK * 8, bool)
        for level in range(1, int(top.max()) + 1):
            for p in probes(key[top >= level], level, BLOCK * 8):
                bits[p.astype(np.int64)] = True
        return pa.table([rows.column("block").slice(0, 1), pa.array([np.packbits(bits, bitorder="little").tobytes()], pa.binary())],
                        ["block", "bytes"])

    return deal, fill


def read_level(filter_bits: np.ndarray, blocks: int, key: np.ndarray) -> np.ndarray:
    """Levels of n-grams: probe one level after the other until one is missing."""
    out = np.zeros(len(key), np.int64)
    at = np.arange(len(key))
    base = block_of(key, blocks) * (BLOCK * 8) if len(key) else at
    level = 1
    while len(at):
        there = np.ones(len(at), bool)
        for p in probes(key[at], level, BLOCK * 8):
            bit = base[at] + p.astype(np.int64)
            there &= (filter_bits[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 == 1
        at = at[there]
        out[at] = level
        level += 1
    return out


def _ship_filter(filled: DataFrame, blocks: int) -> str:
    """The name under which executors find the filter's bytes: one file, put
    together block by block on the driver, which holds one at a time."""
    path = os.path.join(tempfile.mkdtemp(prefix="vialflow-filter-"), f"lm-filter-{uuid.uuid4().hex[:12]}")
    with open(path, "wb") as out:
        out.truncate(blocks * BLOCK)
        for row in filled.toLocalIterator():
            out.seek(row["block"] * BLOCK)
            out.write(row["bytes"])
    filled.sparkSession.sparkContext.addFile(path)
    return os.path.basename(path)


def train(docs: DataFrame, id_col: str = "doc_id", table_words: int = TABLE_WORDS,
          filter_entries: int = FILTER_ENTRIES) -> tuple[DataFrame, dict]:
    """All words (``word, c, mass``) and the model: the frequent words and the
    filter (``bits``, or ``filled``, a table of blocks, if it is large)."""
    counts = count_ngrams(docs.where(~held_out(id_col)))
    words = counts.where(F.col("ctx") == UNIGRAM).select("word", "c")
    powers = range(1, 63)
    n, v, texts, *above = words.agg(
        F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1)),
        F.coalesce(F.sum(F.when(F.col("word") == END, F.col("c"))), F.lit(0)),
        *[F.count(F.when(F.col("c") >= 1 << k, 1)).alias(f"_{k}") for k in powers]).first()
    least = 1 if v <= table_words else next(1 << k for k, m in zip(powers, above) if m <= table_words)
    start = docs.sparkSession.range(1).select(F.lit(START).cast("long").alias("word"), F.lit(texts).cast("long").alias("c"))
    stored = (counts.where(F.col("ctx") != UNIGRAM).select("ctx", "word", _levels(F.col("c"), FLOOR).alias("level")))
    mass = stored.groupBy(F.col("ctx").alias("word")).agg(
        F.sum(F.lit(FLOOR) * F.pow(F.lit(2.0), F.col("level") - 1)).alias("mass"))
    full = words.unionByName(start).join(mass, "word", "left").select(
        "word", "c", F.coalesce("mass", F.lit(0.0)).alias("mass"))
    full = materialise(full, "lm-words")
    entries = stored.agg(F.coalesce(F.sum("level"), F.lit(0))).first()[0]
    blocks = max(1, -(-entries * BITS_PER_ENTRY // (BLOCK * 8)))
    deal, fill = _build(blocks)
    filled = (stored.mapInArrow(deal, "block bigint, key bigint, level int").groupBy("block")
              .applyInArrow(fill, "block bigint, bytes binary"))
    model = {"n": int(n), "v": int(v), "least": least, "blocks": blocks, "bits": None, "filled": None}
    if entries <= filter_entries:
        bits = np.zeros((blocks, BLOCK), np.uint8)
        for row in filled.toLocalIterator():
            bits[row["block"]] = np.frombuffer(row["bytes"], np.uint8)
        model["bits"] = bits.reshape(-1)
    else:
        model["filled"] = materialise(filled, "lm-filter")
    # at most table_words rows, and the start
    known = full.where((F.col("c") >= least) | (F.col("word") == START)).toArrow()
    code = known.column("word").to_numpy().view(_U)
    order = np.argsort(code)
    model |= {"words": code[order], "c": known.column("c").to_numpy()[order], "mass": known.column("mass").to_numpy()[order]}
    return full, model


def _score_texts(texts: list[str], m: dict) -> tuple[np.ndarray, ...]:
    """Per text: tokens, tokens and base of words of the table, what the words of
    the table give to the model score; per word outside the table the text, the
    word and how often it occurs; per pair with such a word that the filter holds
    the text, the context, the word, its level and how often."""
    words, before, sizes = _tokens(texts)
    heads = np.cumsum(sizes) - sizes
    total = m["n"] + ALPHA * (m["v"] + 1)
    at = np.minimum(np.searchsorted(m["words"], words), len(m["words"]) - 1)
    found = m["words"][at] == words
    c = np.where(found, m["c"][at], 0)
    # with all words in the table, a word outside it has count 0
    known = found | (m["least"] == 1)
    base = np.where(known, np.log10((c + ALPHA) / total), 0.0)
    # the context is the token before; a document's first has the start code
    ctx_at, ctx_found = np.r_[0, at[:-1]], np.r_[False, found[:-1]]
    first = np.searchsorted(m["words"], _U(START))
    ctx_at[heads], ctx_found[heads] = first, True
    ctx_known = ctx_found | (m["least"] == 1)
    p0 = (c + ALPHA) / total
    h = np.where(ctx_found, m["c"][ctx_at], 0).astype(np.float64)
    mass = np.where(ctx_found, m["mass"][ctx_at], 0.0)
    pair = np.flatnonzero((mass > 0) | ~ctx_known)
    level = np.zeros(len(words), np.int64)
    level[pair] = read_level(m["bits"], m["blocks"], chain([before[pair], words[pair]]))
    q = np.where(level > 0, FLOOR * 2.0 ** (level - 1), 0.0)
    rest = np.maximum(h - mass, 0.0) + MU
    decided = known & ctx_known
    # of other tokens the terms of a word or context of the table; a context that is not there has 0
    score = np.where(decided, np.log10((q + rest * p0) / (h + MU)), base + np.log10(rest / (h + MU)))
    text = np.repeat(np.arange(len(texts)), sizes)

    def counted(some, *columns):
        """Distinct rows of (text, *columns) at the places ``some``, counted."""
        cols = [text[some], *(x[some] for x in columns)]
        order = np.lexsort(cols[::-1])
        cols = [x[order] for x in cols]
        new = np.zeros(len(some), bool)
        new[:1] = True
        for x in cols:
            new[1:] |= x[1:] != x[:-1]
        cut = np.flatnonzero(new)
        return [x[cut] for x in cols], np.diff(np.r_[cut, len(some)])

    rare, rare_n = counted(np.flatnonzero(~known), words)
    held, held_n = counted(np.flatnonzero(~decided & (level > 0)), before, words, level)
    return (sizes, np.add.reduceat(found.astype(np.int64), heads), np.add.reduceat(base, heads),
            np.add.reduceat(score, heads), (*rare, rare_n), (*held, held_n))


def _scorer(model, texts_per_step: int = 256):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = dict(model.value)
        if m["bits"] is None:
            m["bits"] = np.memmap(SparkFiles.get(m["file"]), np.uint8, "r")
        for batch in batches:
            for at in range(0, batch.num_rows, texts_per_step):
                part = batch.slice(at, texts_per_step)
                sizes, known, base, score, rare, held = _score_texts(part.column("text").to_pylist(), m)

                def lists(doc, *columns):
                    edge = pa.array(np.searchsorted(doc, np.arange(part.num_rows + 1)).astype(np.int32))
                    return [pa.ListArray.from_arrays(edge, pa.array(c.view(np.int64))) for c in columns]

                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in ("rid", "doc_id", "held_out")), pa.array(sizes), pa.array(known),
                     pa.array(base), pa.array(score), *lists(*rare), *lists(*held)],
                    ["rid", "doc_id", "held_out", "n_tokens", "known", "base", "score", "words", "times",
                     "p_ctx", "p_word", "p_level", "p_times"])
    return run


def score(docs: DataFrame, words: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``."""
    model = {k: x for k, x in model.items() if k != "filled"} | (
        {"file": _ship_filter(model["filled"], model["blocks"])} if model["bits"] is None else {})
    sent = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).cast("long").alias("doc_id"),
                       held_out(id_col).alias("held_out"), text_of(text_col).alias("text"))
    scored = materialise(rows.mapInArrow(
        _scorer(sent), "rid bigint, doc_id bigint, held_out boolean, n_tokens bigint, known bigint, base double, "
                       "score double, words array<bigint>, times array<bigint>, p_ctx array<bigint>, "
                       "p_word array<bigint>, p_level array<bigint>, p_times array<bigint>"), "lm-scored")
    total = model["n"] + ALPHA * (model["v"] + 1)
    out = scored.withColumns({x: F.lit(0).cast(t) for x, t in
                              (("_known", "long"), ("_base", "double"), ("_score", "double"))})
    if model["least"] > 1:
        # words outside the table: exact counts by a join, for the word itself and as the context of the next
        h, mass = F.coalesce("c", F.lit(0)), F.coalesce("mass", F.lit(0.0))
        rest = F.greatest(h - mass, F.lit(0.0)) + MU
        p0 = (h + ALPHA) / total
        rare = scored.select("rid", F.explode(F.arrays_zip("words", "times")).alias("r")).select(
            "rid", F.col("r.words").alias("word"), F.col("r.times").alias("times"))
        rare = rare.join(words, "word", "left").select(
            "rid", F.when(h > 0, F.col("times")).otherwise(0).alias("_known"), (F.col("times") * F.log10(p0)).alias("_base"),
            # no token comes after an end
            F.when(F.col("word") == END, F.lit(0.0)).otherwise(F.col("times") * F.log10(rest / (h + MU))).alias("_score"))
        # pairs of such words that the filter holds
        held = scored.select("rid", F.explode(F.arrays_zip("p_ctx", "p_word", "p_level", "p_times")).alias("r")).select(
            "rid", F.col("r.p_ctx").alias("ctx"), F.col("r.p_word").alias("word"), F.col("r.p_level").alias("level"),
            F.col("r.p_times").alias("times"))
        held = held.join(words.select(F.col("word").alias("ctx"), rest.alias("rest"), "mass").where("mass > 0"), "ctx").join(
            words.select("word", "c"), "word", "left")
        q = FLOOR * F.pow(F.lit(2.0), F.col("level") - 1)
        held = held.select("rid", F.lit(0).cast("long").alias("_known"), F.lit(0.0).alias("_base"),
                           (F.col("times") * F.log10(1 + q / (F.col("rest") * p0))).alias("_score"))
        some = materialise(rare.unionByName(held).groupBy("rid").agg(
            F.sum("_known").alias("_known"), F.sum("_base").alias("_base"),
            F.sum(F.col("_base") + F.col("_score")).alias("_score")), "lm-rare")
        out = out.drop("_known", "_base", "_score").join(some, "rid", "left")
    return out.select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("_known", F.lit(0))).alias("n_known"),
        F.lit(model["n"]).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("_base", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("_score", F.lit(0.0))).alias("score"))


@register("op7_lm_scores")
def op7_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and filter-model log10 probabilities of every document."""
    prepare(spark)
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    words, model = train(docs)
    return score(docs, words, model)
