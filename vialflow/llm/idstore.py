"""Token-id shards with a minimal perfect hash index.

File format. A shard is one file of records in ascending document id order
(NULL first); shards in ascending order hold ascending ids. A record is

    id       8 bytes  little-endian signed; NULL is the smallest value
    n        4 bytes  little-endian unsigned: number of ids, end id included
    payload  n * width bytes: little-endian unsigned ids, the end id last
    newline  1 byte

Shards are written by Spark's text sink, one record per row, so they live in
whatever store Spark writes to and task retries are handled by its committer.

Index. Every key (document id) maps to the byte places of its records. Keys
are dealt by hash into buckets of about ``BUCKET`` keys. A bucket with n keys
has n slots and no empty one: keys fall into small groups, and per group a
displacement is searched that sends its keys to free slots (groups of one key
name their slot directly). A slot stores a 32-bit fingerprint of its key and
the places. A look-up costs one bucket, one displacement and one slot; a key
that was never stored is refused by the fingerprint (but for 2 ** -32).

Defined cases: a NULL text is empty and holds the end id alone; a repeated id
keeps all its records, in one run per shard; NULL ids are one key; an empty
table gives no shards, an empty index and no rows; other columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vialflow.llm.common import NULL_ID, id_order, materialise, prepare, read, register, scratch, tasks_for
from vialflow.llm.tokens import ids32, with_ids

_HEAD = "<qI"
_HEAD_BYTES = struct.calcsize(_HEAD)
#: Bytes of text per shard, about.
SHARD_TEXT = 8 << 20
BUCKET = 2048
_GROUP = 2
_TRIES = 64


def write_shards(docs: DataFrame, path: str, tokenizer: str, end_id: int, id_col: str = "doc_id",
                 text_col: str = "text", width: int = 2) -> None:
    """Encode every whole text and write the shards below ``path``.

    The texts are range-partitioned by id once and encoded where they land, so
    neither ids nor texts move again. Equal ids are split by their texts.
    """
    d = docs.select(id_order(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    total = d.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
    d = (d.repartitionByRange(max(tasks_for(docs), total // SHARD_TEXT), "_id", F.xxhash64("_text"))
         .sortWithinPartitions("_id", F.xxhash64("_text")))

    def frame(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = [struct.pack(_HEAD, i, len(b) // width) + b
               for i, b in zip(batch.column("_id").to_pylist(), batch.column("ids").to_pylist())]
        return pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])

    framed = with_ids(d, "_text", tokenizer, end_id, width, then=frame, schema="value binary")
    framed.select(F.col("value").cast("string").alias("value")).write.option("lineSep", "\n").text(path)


def _files(spark: SparkSession, path: str) -> DataFrame:
    """One row per shard file: its number (in id order) and its bytes."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select(F.regexp_extract("path", r"part-(\d+)", 1).cast("long").alias("shard"), "content")


def records(spark: SparkSession, path: str, width: int = 2) -> DataFrame:
    """All records of the shards as they stand in the files: ``shard, place``
    (byte of the record), ``key, before`` (ids in the shard before it),
    ``n_tokens, ids_crc32``."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, content in zip(batch.column("shard").to_pylist(), batch.column("content")):
                data = content.as_buffer()
                view = memoryview(data)
                at = before = 0
                out: list[list[int]] = [[], [], [], [], [], []]
                while at < len(view):
                    key, n = struct.unpack_from(_HEAD, view, at)
                    first = at + _HEAD_BYTES
                    crc = zlib.crc32(ids32(view[first:first + n * width], width))
                    for column, value in zip(out, (shard, at, key, before, n, crc)):
                        column.append(value)
                    at, before = first + n * width + 1, before + n
                    if len(out[0]) == 8192:
                        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names)
                        out = [[], [], [], [], [], []]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names)

    names = ["shard", "place", "key", "before", "n_tokens", "ids_crc32"]
    return _files(spark, path).mapInArrow(scan, ", ".join(f"{c} bigint" for c in names))


# -- minimal perfect hash ----------------------------------------------------

def _mix(h: np.ndarray, d: np.ndarray) -> np.ndarray:
    """64-bit finaliser of ``h`` displaced by ``d`` (fixed odd multipliers)."""
    x = h ^ (np.asarray(d).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def displacements(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(displacement per group, slot per key) of a minimal perfect hash.

    ``h`` are distinct 64-bit key hashes. Displacement d >= 0 sends a key of
    the group to ``mix(h, d) % n``; d < 0 names slot ``-d - 1``.
    """
    n = len(h)
    group = (h % np.uint64(-(-n // _GROUP))).astype(np.int64)
    order = np.argsort(group, kind="stable")
    parts = np.split(order, np.flatnonzero(np.diff(group[order])) + 1)
    disp, slot, taken = np.zeros(-(-n // _GROUP), np.int64), np.zeros(n, np.int64), np.zeros(n, bool)
    singles = []
    for keys in sorted(parts, key=len, reverse=True):
        if len(keys) == 1:
            singles.append(keys[0])
            continue
        d = 0
        while True:
            want = (_mix(h[keys][:, None], np.arange(d, d + _TRIES)) % np.uint64(n)).astype(np.int64)
            free = ~taken[want].any(0)
            ranked = np.sort(want, 0)
            free &= (ranked[1:] != ranked[:-1]).all(0)
            if free.any():
                break
            d += _TRIES
        i = int(np.argmax(free))
        disp[group[keys[0]]], slot[keys] = d + i, want[:, i]
        taken[want[:, i]] = True
    for key, free in zip(singles, np.flatnonzero(~taken)):
        disp[group[key]], slot[key] = -int(free) - 1, free
    return disp, slot


def slots_of(h: np.ndarray, disp: np.ndarray, n: int) -> np.ndarray:
    """Slots of key hashes ``h`` under a bucket's displacements."""
    d = disp[(h % np.uint64(len(disp))).astype(np.int64)]
    return np.where(d < 0, -d - 1, (_mix(h, np.maximum(d, 0)) % np.uint64(n)).astype(np.int64))


def _hash(key: Column) -> Column:
    return F.xxhash64(key, F.lit("slot"))


def _print(key: Column) -> Column:
    return F.xxhash64(F.lit("print"), key).bitwiseAND(F.lit((1 << 32) - 1))


def _bucket(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.lit("bucket"), key), F.lit(buckets))


def build_index(found: DataFrame, buckets: int) -> DataFrame:
    """Index of ``found`` (``key, shard, place``): per bucket the displacements
    and, in slot order, fingerprints and places (runs of records in a shard)."""
    runs = found.groupBy("key", "shard").agg(F.min("place").alias("place"), F.count(F.lit(1)).alias("n"))
    keys = runs.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("shard", "place", "n"))).alias("runs"))
    keys = keys.select(_bucket(F.col("key"), buckets).alias("bucket"), _hash(F.col("key")).alias("h"),
                       _print(F.col("key")).alias("print"), "runs")

    def build(rows: pa.Table) -> pa.Table:
        disp, slot = displacements(rows.column("h").to_numpy().view(np.uint64))
        rows = rows.take(pa.array(np.argsort(slot)))
        return pa.table([rows.column("bucket").slice(0, 1), pa.array([disp]), pa.array([rows.column("print").to_numpy()]),
                         pa.array([rows.column("runs").to_pylist()], _RUNS)], ["bucket", "disp", "prints", "runs"])

    return keys.groupBy("bucket").applyInArrow(
        build, "bucket bigint, disp array<bigint>, prints array<bigint>, "
               "runs array<array<struct<shard:bigint,place:bigint,n:bigint>>>")


_RUN = pa.struct([("shard", pa.int64()), ("place", pa.int64()), ("n", pa.int64())])
_RUNS = pa.list_(pa.list_(_RUN))


def look_up(index: DataFrame, keys: DataFrame, buckets: int) -> DataFrame:
    """``key, runs`` of those ``keys`` (column ``key``) that the index holds."""
    ask = keys.select("key").distinct().select(
        _bucket(F.col("key"), buckets).alias("bucket"), "key", _hash(F.col("key")).alias("h"),
        _print(F.col("key")).alias("print"))

    def find(part: pa.Table, asked: pa.Table) -> pa.Table:
        if not part.num_rows or not asked.num_rows:
            return pa.table([pa.array([], pa.int64()), pa.array([], pa.list_(_RUN))], ["key", "runs"])
        row = part.slice(0, 1)
        disp = np.array(row.column("disp")[0].as_py())
        prints = np.array(row.column("prints")[0].as_py())
        slot = slots_of(asked.column("h").to_numpy().view(np.uint64), disp, len(prints))
        hit = np.flatnonzero(prints[slot] == asked.column("print").to_numpy())
        runs = row.column("runs").combine_chunks().flatten().take(pa.array(slot[hit]))
        return pa.table([asked.column("key").take(pa.array(hit)), runs.cast(pa.list_(_RUN))], ["key", "runs"])

    return index.groupBy("bucket").cogroup(ask.groupBy("bucket")).applyInArrow(
        find, "key bigint, runs array<struct<shard:bigint,place:bigint,n:bigint>>")


def fetch(spark: SparkSession, path: str, index: DataFrame, keys: DataFrame, buckets: int, width: int = 2) -> DataFrame:
    """``key, ids`` (little-endian unsigned 32-bit) of the records of ``keys``,
    cut out of the shard files at the places that the index names."""
    runs = look_up(index, keys, buckets).select("key", F.explode("runs").alias("r")).select("key", "r.*")
    asked = runs.groupBy("shard").agg(F.collect_list(F.struct("key", "place", "n")).alias("asked"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                view = memoryview(batch.column("content")[i].as_buffer())
                keys, ids = [], []
                for r in batch.column("asked")[i].as_py():
                    at = r["place"]
                    for _ in range(r["n"]):
                        key, n = struct.unpack_from(_HEAD, view, at)
                        if key != r["key"]:
                            raise ValueError(f"record at {at} belongs to another key")
                        first = at + _HEAD_BYTES
                        keys.append(key), ids.append(ids32(view[first:first + n * width], width))
                        at = first + n * width + 1
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(ids, pa.binary())], ["key", "ids"])

    return _files(spark, path).join(asked, "shard").select("content", "asked").mapInArrow(cut, "key bigint, ids binary")


class Store:
    """Written shards with their scanned records and index."""

    def __init__(self, spark: SparkSession, path: str, width: int = 2):
        self.spark, self.path, self.width = spark, path, width
        self.records = materialise(records(spark, path, width), "idstore-records")
        keys = self.records.select("key").distinct().count()
        self.buckets = max(1, -(-keys // BUCKET))
        self.index = materialise(build_index(self.records, self.buckets), "idstore-index")

    def look_up(self, keys: DataFrame) -> DataFrame:
        return look_up(self.index, keys, self.buckets)

    def fetch(self, keys: DataFrame) -> DataFrame:
        return fetch(self.spark, self.path, self.index, keys, self.buckets, self.width)

    def read_all(self, keys: DataFrame) -> DataFrame:
        """``key, start, n_tokens, ids_crc32`` of every record of ``keys``.

        For whole tables: the files were read once, in order, by ``records``;
        the index says at which place each key's run begins, and the run's
        records follow it. Only small rows are joined, never file contents.
        """
        runs = self.look_up(keys).select("key", F.explode("runs").alias("r")).select("key", "r.*")
        runs = runs.select("key", "shard", "place", "n")
        per_shard = self.records.groupBy("shard").agg(F.sum("n_tokens").alias("_sum"))
        before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
        base = per_shard.select("shard", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("base"))
        single = runs.where("n = 1").select("key", "shard", "place").join(self.records.drop("key"), ["shard", "place"])
        many = (runs.where("n > 1").select("key", "shard", F.col("place").alias("_first"))
                .join(self.records, ["key", "shard"]).where("place >= _first").drop("_first"))
        # one row per shard file: bounded by the number of shards
        return (single.unionByName(many).join(F.broadcast(base), "shard")
                .select("key", (F.col("base") + F.col("before")).alias("start"), "n_tokens", "ids_crc32"))


@register("op10_id_store")
def op10_id_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all documents as id shards, index them, and read them back by key."""
    import public_tokenizers
    prepare(spark)
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    path = scratch(spark, "id-shards")
    write_shards(docs, path, public_tokenizers.path("byte_bpe_50k.json"), end_id=0)
    keys = docs.select(id_order("doc_id").alias("key"))
    found = Store(spark, path).read_all(keys)
    return found.select(F.when(F.col("key") != NULL_ID, F.col("key")).alias("doc_id"), "start", "n_tokens", "ids_crc32")
