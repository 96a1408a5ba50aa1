"""Exact search for windows that also start in an earlier document.

A window is ``length`` consecutive units (bytes or words) of one document. For
every window the question is whether the same units also start in a document
with a smaller id. Shuffling every window would move fifty times the corpus;
this engine moves a fraction of it and loses nothing:

1. Every window is represented by its anchor: the ``gram`` consecutive units
   inside it whose hash is smallest (leftmost on ties). Equal windows have
   equal anchors at equal places, and neighbouring windows mostly share one,
   so a document becomes a list of blocks: the windows of one anchor, a
   handful of units apart, with a fingerprint of the text they span.
2. Per anchor, one aggregate says whether it occurs in several documents and
   with several block texts. Anchors of one document are done.
3. Blocks of the other anchors are joined back. Where an anchor has a single
   block text, its windows repeat in every document but the first.
4. Where block texts differ (the ends of repeated passages), the first
   document of each distinct block text supplies its units, and ``resolve`` (a
   suffix sort or a phrase parse, see the callers) finds the windows that an
   earlier document has too. Its answers return to all documents with that
   block; the block's other windows repeat in all of them but the first.

Rows are combined per kernel call before the first shuffle, and the others
move in equi-joins that AQE can split, so neither a passage in a third of all
documents nor thousands of copies meet in one task. Blocks are told apart by
63 bits within an anchor of 48 bits; windows by their units, or by 128-bit
digests where equal ones may lie in several tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vialflow.llm.common import id_order, materialise, tasks_for, text_of
from vialflow.session import small

_U = np.uint64
#: Bits of the filter of shared anchors, at most (128 MB), and per anchor.
FILTER_BITS, BITS_PER_ANCHOR = 1 << 30, 16
_SEGMENT = 1 << 19
#: Blocks of one anchor that are parsed in one task; more are spread.
GROUP = 1 << 11
#: Windows that one range of a sort or parse holds, about.
RANGE_WINDOWS = 1 << 19

#: Units per kernel call; a longer document is read in overlapping stretches.
_STRETCH = 1 << 19
_PLACE_BITS = 24
_KNOWN_WORDS = 100_000


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (fixed odd multipliers)."""
    x = x ^ (x >> _U(33))
    x *= _U(0xFF51AFD7ED558CCD)
    x ^= x >> _U(29)
    x *= _U(0xC4CEB9FE1A85EC53)
    x ^= x >> _U(32)
    return x


def chain(parts, seed: int = 0x9E3779B97F4A7C15) -> np.ndarray:
    """Hash of a sequence of equally long uint64 arrays, element by element."""
    h = None
    for p in parts:
        h = mix((_U(seed) if h is None else h) ^ (p * _U(0x9E3779B97F4A7C15)))
    return h


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash
        if len(self) > _KNOWN_WORDS:
            self.clear()
        self[word] = code = xxhash.xxh3_64_intdigest(word)
        return code


_CODES = _Words()


def word_units(text: bytes) -> np.ndarray:
    """One 64-bit code per word; bytes.split knows exactly the six separators."""
    return np.array([_CODES[w] for w in text.split()], _U)


def byte_units(text: bytes) -> np.ndarray:
    return np.frombuffer(text, np.uint8)


def byte_codes(units: np.ndarray) -> np.ndarray:
    """At each byte the eight bytes from it on (zero-padded), big-endian."""
    padded = np.concatenate([units, np.zeros(8, np.uint8)])
    return np.ndarray((len(units),), ">u8", padded.data, strides=(1,)).astype(_U)


@dataclass(frozen=True)
class Unit:
    """How texts are read: units, 64-bit codes at each unit, window sizes."""

    units: Callable[[bytes], np.ndarray]
    codes: Callable[[np.ndarray], np.ndarray]
    kind: str            # numpy type of a unit
    length: int          # units of a window
    gram: int            # units of an anchor
    step: int            # units that one code covers

    def offsets(self, n: int) -> list[int]:
        """Places of the codes that together cover n units."""
        return sorted({*range(0, n - self.step + 1, self.step), n - self.step})


BYTES = Unit(byte_units, byte_codes, "u1", length=50, gram=20, step=8)
WORDS = Unit(word_units, lambda units: units, "<u8", length=13, gram=5, step=1)


def blocks_of(codes: np.ndarray, ends: np.ndarray, unit: Unit) -> tuple[np.ndarray, ...]:
    """Blocks of documents laid end to end (``ends``: where each ends).

    Returns anchor hash, block fingerprint, first window, window count and the
    anchor's distance from the first window.
    """
    n, span = len(codes), unit.length - unit.gram + 1
    none = np.zeros(0, np.int64)
    if n < unit.length:
        return none.view(_U), none.view(_U), none, none, none
    sizes = np.diff(ends, prepend=0)
    room = np.repeat(ends, sizes) - np.arange(n)              # units left in the document
    window = np.flatnonzero(room >= unit.length)
    if not len(window):
        return none.view(_U), none.view(_U), none, none, none
    width = n - unit.gram + 1
    grams = chain([codes[o:o + width] for o in unit.offsets(unit.gram)])
    low = _U((1 << _PLACE_BITS) - 1)
    least = (grams & ~low) | np.arange(width, dtype=_U)
    reach = 1
    while reach * 2 <= span:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    if reach < span:
        least = np.minimum(least[:-(span - reach)], least[span - reach:])
    at = (least[window] & low).astype(np.int64)
    first = np.r_[0, np.flatnonzero(np.diff(at)) + 1]
    count = np.diff(np.r_[first, len(at)])
    left, right = window[first], window[first] + count - 1 + unit.length
    parts = [(right - left).astype(_U), *(codes[left + o] for o in unit.offsets(unit.length))]
    tail = span - 1                                            # units a block may have beyond one window
    parts += [codes[right - tail + o] for o in unit.offsets(tail)] if tail >= unit.step else []
    # anchors may collide (their blocks are compared then), block texts must not;
    # 63 bits, so that differences of fingerprints fit a long
    return grams[at[first]] >> _U(16), chain(parts) >> _U(1), left, count, at[first] - left


def _stretches(texts, unit: Unit) -> Iterator[tuple[np.ndarray, np.ndarray, list[int], list[int]]]:
    """Codes, ends, document numbers and offsets of kernel calls over ``texts``
    (an Arrow string array)."""
    held: list[np.ndarray] = []
    docs: list[int] = []
    base: list[int] = []
    size = 0

    def flush():
        return np.concatenate(held), np.cumsum([len(c) for c in held]), list(docs), list(base)

    for i, t in enumerate(texts):
        units = unit.units(t.as_py().encode())
        for start in range(0, max(1, len(units) - unit.length + 1), _STRETCH):
            part = units[start:start + _STRETCH + unit.length - 1]
            if len(part) < unit.length:
                continue
            held.append(unit.codes(part)), docs.append(i), base.append(start)
            size += len(part)
            if size >= _STRETCH:
                yield flush()
                held, docs, base, size = [], [], [], 0
    if held:
        yield flush()


def _summaries(unit: Unit):
    """Arrow function: (ord, key, text) to one row per anchor of a kernel call
    with its smallest and largest block (the largest as a difference), its
    smallest id and whether it has several ids (ids may be 2^63 apart)."""
    names = ["anchor", "block", "block_up", "ord", "several"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("ord").to_numpy()
            for codes, ends, docs, _ in _stretches(batch.column("text"), unit):
                anchor, block, left, _, _ = blocks_of(codes, ends, unit)
                if not len(anchor):
                    continue
                ids_of = ids[np.array(docs)[np.searchsorted(ends, left, side="right")]]
                order = np.argsort(anchor)
                a, b, i = anchor[order], block[order].view(np.int64), ids_of[order]
                head = np.flatnonzero(np.r_[True, a[1:] != a[:-1]])
                b0, i0 = np.minimum.reduceat(b, head), np.minimum.reduceat(i, head)
                several = np.maximum.reduceat(i, head) > i0
                cols = [a[head].view(np.int64), b0, np.maximum.reduceat(b, head) - b0, i0, several]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names)

    return run, ", ".join(f"{c} bigint" for c in names[:-1]) + ", several boolean"


def _blocks(unit: Unit, shared):
    """Arrow function: (ord, key, text) to the blocks whose anchors may be
    shared, by a broadcast filter of anchors."""
    names = ["anchor", "block", "ord", "key", "lo", "n", "off"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        low = _U(len(bits) * 8 - 1)
        for batch in batches:
            ids, keys = (batch.column(c).to_numpy() for c in ("ord", "key"))
            for codes, ends, docs, base in _stretches(batch.column("text"), unit):
                anchor, block, left, count, off = blocks_of(codes, ends, unit)
                place = (anchor & low).astype(np.int64)
                some = np.flatnonzero((bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1)
                part = np.searchsorted(ends, left[some], side="right")
                doc = np.array(docs)[part]
                lo = left[some] - np.r_[0, ends[:-1]][part] + np.array(base)[part]
                cols = [anchor[some].view(np.int64), block[some].view(np.int64), ids[doc], keys[doc], lo, count[some], off[some]]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names)

    return run, ", ".join(f"{c} bigint" for c in names)


def _anchor_filter(shared: DataFrame) -> np.ndarray:
    """Bits of the shared anchors: ``FILTER_BITS`` at most, so it may be
    broadcast at any corpus size; it only spares rows and drops no anchor."""
    bits = _SEGMENT
    while bits < min(shared.count() * BITS_PER_ANCHOR, FILTER_BITS):
        bits *= 2

    def fill(rows: pa.Table) -> pa.Table:
        set_bits = np.zeros(_SEGMENT, bool)
        set_bits[rows.column("place").to_numpy() % _SEGMENT] = True
        return pa.table([rows.column("segment").slice(0, 1),
                         pa.array([np.packbits(set_bits, bitorder="little").tobytes()], pa.binary())], ["segment", "bytes"])

    place = F.col("anchor").bitwiseAND(F.lit(bits - 1))
    rows = shared.select(place.alias("place")).distinct().withColumn("segment", F.floor(F.col("place") / _SEGMENT))
    out = np.zeros((bits // _SEGMENT, _SEGMENT // 8), np.uint8)
    for row in rows.groupBy("segment").applyInArrow(fill, "segment bigint, bytes binary").toLocalIterator():
        out[row["segment"]] = np.frombuffer(row["bytes"], np.uint8)
    return out.reshape(-1)


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``ord`` (id, NULL first), ``key`` (hash of the text) and the text."""
    return docs.select(id_order(id_col).alias("ord"), F.xxhash64(text_of(text_col)).alias("key"),
                       text_of(text_col).alias("text"))


def _contexts(unit: Unit):
    """Arrow function: a document with the blocks it stands for to their units,
    and the units of their anchors."""
    names = ["anchor", "block", "ord", "lead", "units"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                units = unit.units(batch.column("text")[i].as_py().encode())
                asked = batch.column("asked")[i].values
                anchor, block, lo, n, off = (asked.field(c).to_numpy() for c in ("anchor", "block", "lo", "n", "off"))
                cut = [units[a:b].tobytes() for a, b in zip(lo, lo + n - 1 + unit.length)]
                lead = [units[a:a + unit.gram].tobytes() for a in lo + off]
                ids = np.full(len(lo), batch.column("ord")[i].as_py(), np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor), pa.array(block), pa.array(ids), pa.array(lead, pa.binary()),
                     pa.array(cut, pa.binary())], names)
    return run


#: What a parse returns per run of windows: windows at .. at + n - 1 of a
#: block start in document ``first``; for ``open`` rows that is the block's own
#: document, as this task knows no earlier one, and (d1, d2) is the window's digest.
RESOLVED = "anchor bigint, block bigint, at bigint, n bigint, first bigint, open boolean, d1 bigint, d2 bigint"


def settle(runs: DataFrame) -> DataFrame:
    """``runs`` and, for open windows that start in an earlier document of another
    task, runs that name it. Each task's first document of a window is among the
    open rows, so no others are compared."""
    ends = runs.where("open").select("anchor", "block", "at", "n", F.col("first").alias("own"), "d1", "d2")
    least = ends.groupBy("d1", "d2").agg(F.min("own").alias("first"), F.max("own").alias("last")).where("first < last")
    later = ends.join(small(least.drop("last")), ["d1", "d2"]).where("first < own")
    return runs.drop("open", "d1", "d2").unionByName(later.drop("own", "d1", "d2"))


def repeated(docs: DataFrame, unit: Unit, resolve: Callable[[DataFrame, int], DataFrame],
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Runs of repeated windows: ``ord, key, lo, n`` (windows lo .. lo + n - 1).

    ``resolve`` gets the distinct blocks (``anchor, block, ord, lead, units``;
    ``ord`` is the first document with the block, ``lead`` holds the anchor's
    units) of anchors with several block texts and a number of ranges, and
    returns ``anchor, block, at, n, first``: windows at .. at + n - 1 of the
    block start in document ``first``, one earlier than ``ord`` if there is any.
    """
    source = keyed(docs, id_col, text_col)
    # at most one row per anchor and kernel call, so the rows are dealt out once
    seen = source.mapInArrow(*_summaries(unit)).repartition(tasks_for(docs), "anchor")
    per = seen.groupBy("anchor").agg(
        F.min("block").alias("b0"), F.max(F.col("block") + F.col("block_up")).alias("b1"),
        F.min("ord").alias("first"), F.max("ord").alias("last"), F.max("several").alias("several"))
    shared = materialise(per.where("several or first < last").select("anchor", "first", (F.col("b0") != F.col("b1")).alias("mixed")),
                         "repeats-anchors")
    bits = docs.sparkSession.sparkContext.broadcast(_anchor_filter(shared))
    back = source.mapInArrow(*_blocks(unit, bits)).join(shared, "anchor")
    found = materialise(back.where("mixed or ord > first").drop("first"), "repeats-blocks")
    plain = found.where("not mixed").select("ord", "key", "lo", "n")

    mixed = found.where("mixed")
    one = mixed.groupBy("anchor", "block").agg(F.min(F.struct("ord", "key", "lo", "n", "off")).alias("r")).select(
        "anchor", "block", "r.*")
    asked = one.groupBy("ord", "key").agg(F.collect_list(F.struct("anchor", "block", "lo", "n", "off")).alias("asked"))
    texts = source.join(asked, ["ord", "key"])
    reps = materialise(texts.select("ord", "text", "asked").mapInArrow(
        _contexts(unit), "anchor bigint, block bigint, ord bigint, lead binary, units binary"), "repeats-contexts")
    ranges = max(tasks_for(docs), -(-reps.count() * (unit.length - unit.gram + 1) // RANGE_WINDOWS))
    runs = resolve(reps, ranges).select("anchor", "block", "at", "n", "first")
    partly = (mixed.select("anchor", "block", "ord", "key", "lo")
              .join(runs, ["anchor", "block"]).where("first < ord")
              .select("ord", "key", (F.col("lo") + F.col("at")).alias("lo"), "n"))
    return plain.unionByName(partly)


def dealt(reps: DataFrame, n: int) -> DataFrame:
    """Blocks range-partitioned by their anchors' units; Spark samples the
    splitters. Anchors with more than ``GROUP`` blocks are spread over several
    ranges and marked ``open``: their windows are compared across ranges."""
    big = reps.groupBy("lead").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > GROUP)
    led = reps.join(small(big), "lead", "left").withColumn("open", F.col("_n").isNotNull())
    led = led.withColumn("salt", F.when(F.col("open"), F.pmod("block", F.ceil(F.col("_n") / GROUP))).otherwise(F.lit(0)))
    return led.repartitionByRange(n, "lead", "salt").select("anchor", "block", "ord", "lead", "units", "open")


def whole(batches: Iterator[pa.RecordBatch]) -> pa.Table | None:
    """The rows of one task as a table."""
    found = [b for b in batches if b.num_rows]
    return pa.Table.from_batches(found) if found else None


def resolved_rows(reps: pa.Table, row: np.ndarray, at: np.ndarray, digests: list[np.ndarray], first: np.ndarray,
                  open_row: np.ndarray) -> pa.RecordBatch:
    """``RESOLVED`` rows: windows of one block with the same first document
    are one run; blocks that may go on in another task list the windows that no
    earlier document has here one by one."""
    is_open = open_row[row] & (first == reps.column("ord").to_numpy()[row])
    start = np.r_[True, (row[1:] != row[:-1]) | (first[1:] != first[:-1]) | is_open[1:] | is_open[:-1]] if len(row) else np.zeros(0, bool)
    head = np.flatnonzero(start)
    n = np.diff(np.r_[head, len(row)])
    some = is_open[head]
    digests = [np.where(some, d[head].view(np.int64), 0) for d in digests]
    which = pa.array(row[head])
    return pa.RecordBatch.from_arrays(
        [reps.column("anchor").combine_chunks().take(which), reps.column("block").combine_chunks().take(which),
         pa.array(at[head]), pa.array(n), pa.array(first[head]), pa.array(some), *map(pa.array, digests)],
        ["anchor", "block", "at", "n", "first", "open", "d1", "d2"])


def _spans(lo: np.ndarray, n: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs [start, stop) of units that the windows cover."""
    order = np.argsort(lo, kind="stable")
    start, stop = lo[order], np.maximum.accumulate((lo + n - 1 + length)[order])
    fresh = np.flatnonzero(np.r_[len(lo) > 0, start[1:] > stop[:-1]])
    return start[fresh], stop[np.r_[fresh[1:], len(lo)][:len(fresh)] - 1]


def _rest(raw: bytes, runs: pa.StructScalar, words: bool, length: int) -> tuple[bytes, int, int, int]:
    """What stays of a text, its units, and the units and runs that go."""
    units = raw.split() if words else raw
    kept, gone, k = units, 0, 0
    if runs.is_valid:
        lo, n = (runs.values.field(c).to_numpy() for c in ("lo", "n"))
        start, stop = _spans(lo, n, length)
        gone, k = int((stop - start).sum()), len(start)
        stay = zip(np.r_[0, stop].tolist(), np.r_[start, len(units)].tolist())
        kept = [u for a, b in stay for u in units[a:b]] if words else b"".join(units[a:b] for a, b in stay)
    return b" ".join(kept) if words else kept, len(units), gone, k


def _readable(kept: bytes) -> bytes:
    """Without halves of characters at seams."""
    return kept.decode(errors="ignore").encode()


def _strip(words: bool, length: int, with_text: bool):
    """Arrow function: rows with their repeated runs to what is left of them."""
    import hashlib

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            others = [c for c in batch.schema.names if c not in ("text", "runs")]
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                total, removed, spans, digest, left = [], [], [], [], []
                for text, runs in zip(part.column("text"), part.column("runs")):
                    kept, n, gone, k = _rest(text.as_py().encode(), runs, words, length)
                    total.append(n), removed.append(gone), spans.append(k)
                    digest.append(hashlib.sha256(kept).hexdigest()), left.append(_readable(kept) if with_text else None)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in others), *(pa.array(c, pa.int64()) for c in (total, removed, spans)),
                     pa.array(digest, pa.string()), pa.array(left, pa.binary())],
                    [*others, "n_units", "n_removed", "n_spans", "kept_sha256", "kept"])

    return run


def cut_text(docs: DataFrame, runs: DataFrame, words: bool, length: int, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """``docs``, all columns, with the repeated runs cut out of the texts. The
    texts move once, to meet their runs; a NULL text stays NULL."""
    per = runs.groupBy("ord", "key").agg(F.collect_set(F.struct("lo", "n")).alias("_runs")).select(
        F.col("ord").alias("_ord"), F.col("key").alias("_key"), "_runs")
    d = docs.withColumns({"_o": id_order(id_col), "_k": F.xxhash64(text_of(text_col))})
    d = d.join(per, (F.col("_o") == F.col("_ord")) & (F.col("_k") == F.col("_key")), "left").select(*docs.columns, "_runs")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [_readable(_rest(t.as_py().encode(), r, words, length)[0]).decode() if r.is_valid else t.as_py()
                     for t, r in zip(batch.column(text_col), batch.column("_runs"))]
            names = [c for c in batch.schema.names if c != "_runs"]
            yield pa.RecordBatch.from_arrays(
                [pa.array(texts, pa.string()) if c == text_col else batch.column(c) for c in names], names)

    return d.mapInArrow(run, docs.schema)


def strip(docs: DataFrame, runs: DataFrame, words: bool, length: int, id_col: str = "doc_id",
          text_col: str = "text", with_text: bool = True) -> DataFrame:
    """Every row's id and what stays of its text: ``n_units, n_removed,
    n_spans, kept_sha256`` (of the bytes that stay) and ``kept`` (binary UTF-8
    without halves of characters at seams; NULL unless ``with_text``)."""
    per = runs.groupBy("ord", "key").agg(F.collect_set(F.struct("lo", "n")).alias("runs"))
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), id_order(id_col).alias("ord"),
                    F.xxhash64(text_of(text_col)).alias("key"), text_of(text_col).alias("text"))
    joined = d.join(per, ["ord", "key"], "left").select("doc_id", "ord", "key", "text", "runs")
    return joined.mapInArrow(_strip(words, length, with_text), "doc_id bigint, ord bigint, key bigint, n_units bigint, n_removed bigint, "
                                                    "n_spans bigint, kept_sha256 string, kept binary")
