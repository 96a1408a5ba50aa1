"""Packing documents into token sequences along a space-filling curve.

Every document becomes a hashed bag of token ids, projected by a fixed random
matrix to ``DIMS`` coordinates; their cell on a grid gives its key on the
Hilbert curve, so documents with similar words get nearby keys. Documents are
range-sorted by that key (ties by id and row), laid end to end along the
curve, and the line of tokens is cut every ``max_tokens``: each sequence holds
neighbours on the curve, and only the very last one needs padding.

Distribution: tokens are written once; keys and lengths (a few bytes per
document) are range-partitioned and summed per partition, one total per
partition gives each its offset, and the offsets return to the tokens by an
equi-join on the row number. Equal keys (copies) are split by id and row.

Defined cases: a NULL text is empty and consists of the end id alone; NULL ids
sort first and are returned as NULL; repeated rows are packed each; a text
longer than a sequence is cut into several pieces; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vialflow.llm.common import id_order, materialise, prepare, read, register, tasks_for
from vialflow.llm.tokens import ids32, with_ids

MAX_TOKENS = 4096
#: Bytes per stored id: the vocabulary has fewer than 2 ** 16 ids.
WIDTH = 2
DIMS, BITS, HASHED = 4, 12, 1024


def hilbert_key(cells: np.ndarray, bits: int) -> np.ndarray:
    """Index along the Hilbert curve of integer cells (rows: points).

    The cells' bit planes are read from the highest down. Each plane names one
    of the 2 ** d sub-cubes; its Gray rank is the next digit of the index, and
    the sub-cube's own curve is a reflection and rotation of the whole one:
    ``entry`` holds the corner where it starts and ``turn`` its axis.
    """
    n, d = cells.shape
    mask = (1 << d) - 1
    cells = cells.astype(np.int64)
    key = np.zeros(n, np.int64)
    entry = np.zeros(n, np.int64)
    turn = np.zeros(n, np.int64)

    def rotate_right(x, by):
        by = by % d
        return ((x >> by) | (x << (d - by))) & mask

    def rotate_left(x, by):
        return rotate_right(x, (d - by % d) % d)

    def gray(x):
        return x ^ (x >> 1)

    def rank(g):
        r, shift = g.copy(), 1
        while shift < d:
            r ^= r >> shift
            shift *= 2
        return r

    for plane in range(bits - 1, -1, -1):
        corner = np.zeros(n, np.int64)
        for axis in range(d):
            corner |= ((cells[:, axis] >> plane) & 1) << axis
        w = rank(rotate_right(corner ^ entry, turn + 1))
        key = (key << d) | w
        # corner where sub-cube w is entered, and the axis along which it is crossed
        first = np.where(w == 0, 0, gray(2 * ((np.maximum(w, 1) - 1) // 2)))
        odd = np.where(w % 2 == 0, w - 1, w)
        ones = np.zeros(n, np.int64)
        run = np.maximum(odd, 0).copy()
        for _ in range(d):
            step = (run & 1) == 1
            ones += step
            run = np.where(step, run >> 1, 0)
        axis = np.where(w == 0, 0, ones % d)
        entry = entry ^ rotate_left(first, turn + 1)
        turn = (turn + axis + 1) % d
    return key


def _projection(n_ids: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    return rng.integers(0, HASHED, n_ids), rng.standard_normal((HASHED, DIMS))


def _keyed(width: int, seed: int):
    """Arrow function: a batch with ``ids`` gets the documents' curve keys."""
    made: list = []

    def add(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not made:
            made.extend(_projection(1 << 16, seed))
        place, project = made
        points = np.empty((batch.num_rows, DIMS))
        for i, b in enumerate(batch.column("ids").to_pylist()):
            counts = np.bincount(place[np.frombuffer(b, f"<u{width}") & 0xFFFF], minlength=HASHED).astype(np.float64)
            points[i] = (counts / np.sqrt(counts @ counts)) @ project
        grid = np.minimum((0.5 + 0.5 * np.tanh(points)) * (1 << BITS), (1 << BITS) - 1).astype(np.int64)
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(hilbert_key(grid, BITS))], [*batch.schema.names, "_curve"])

    return add


def running_start(rows: DataFrame, order: list[str], value: str, out: str, n: int) -> DataFrame:
    """``rows`` plus the sum of ``value`` over all rows before, in ``order``.

    Rows are range-partitioned by the whole order, the partition numbers are
    fixed by writing them, and each partition adds the total of those before.
    """
    dealt = rows.repartitionByRange(n, *order).withColumn("_part", F.spark_partition_id())
    dealt = materialise(dealt, "running-start")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    base = (dealt.groupBy("_part").agg(F.sum(value).alias("_sum"))
            .select("_part", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_base")))
    local = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    # one row per partition: the right side is as small as the partition count
    return (dealt.withColumn("_local", F.coalesce(F.sum(value).over(local), F.lit(0)))
            .join(F.broadcast(base), "_part").withColumn(out, F.col("_base") + F.col("_local"))
            .drop("_part", "_base", "_local"))


def _cut(max_tokens: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                row, start, length, ids, total, seq, offset = [], [], [], [], [], [], []
                for i, (b, g) in enumerate(zip(part.column("ids"), part.column("_start").to_pylist())):
                    whole = ids32(b.as_py(), width)
                    n = len(whole) // 4
                    s = 0
                    while s < n:
                        k = min(n - s, max_tokens - (g + s) % max_tokens)
                        row.append(i), start.append(s), length.append(k), total.append(n)
                        ids.append(whole[4 * s:4 * (s + k)])
                        seq.append((g + s) // max_tokens), offset.append((g + s) % max_tokens)
                        s += k
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(pa.array(row, pa.int64())), *(pa.array(c, pa.int64()) for c in (start, length)),
                     pa.array(ids, pa.binary()), *(pa.array(c, pa.int64()) for c in (total, seq, offset))],
                    ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])
    return run


def pack(docs: DataFrame, tokenizer: str, end_id: int, max_tokens: int = MAX_TOKENS, id_col: str = "doc_id",
         text_col: str = "text", width: int = WIDTH, seed: int = 11) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids`` (binary, little-endian
    unsigned 32-bit), ``doc_tokens, sequence_id, offset``."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), id_order(id_col).alias("_order"),
                       F.monotonically_increasing_id().alias("_rid"), F.col(text_col).alias("_text"))
    tokens = materialise(with_ids(rows, "_text", tokenizer, end_id, width, then=_keyed(width, seed),
                                  schema="doc_id bigint, _order bigint, _rid bigint, ids binary, _curve bigint"), "pack-tokens")
    lengths = tokens.select("_rid", "_curve", "_order", (F.octet_length("ids") / width).cast("long").alias("_n"))
    starts = running_start(lengths, ["_curve", "_order", "_rid"], "_n", "_start", tasks_for(docs))
    placed = tokens.select("_rid", "doc_id", "ids").join(starts.select("_rid", "_start"), "_rid")
    return placed.select("doc_id", "_start", "ids").mapInArrow(
        _cut(max_tokens, width), "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, "
                                 "sequence_id bigint, offset bigint")


@register("op2_pack_curve")
def op2_pack_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 4096 tokens, neighbours on the curve together."""
    import public_tokenizers
    prepare(spark)
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=2).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
