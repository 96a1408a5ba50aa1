"""Duplicate word spans by a relative Lempel-Ziv parse.

Every word that a window of 13 words covers which also starts in a document
with a smaller id is removed:

* ``repeats`` cuts documents into phrases around anchors and brings together
  the phrases of anchors that occur in several documents, in reference blocks
  by ranges of the anchors (equal phrases are one, and the document that has it
  first stands for it). Where an anchor has one phrase only, that phrase as a
  whole is the factor, and its first document is known from an aggregate;
* a reference block indexes the place where each 13-word string of its phrases
  occurs first (``Reference``);
* each phrase is parsed greedily from left to right (``parse``): words without
  an earlier string are literals; at an earlier string a factor starts, which
  copies from the indexed place as long as the words agree;
* the next look-up is at the first string that reaches over the factor's end,
  so none is lost at a boundary. Phrases of an anchor that is spread over
  several blocks are factored against all of them by their strings' digests.

A factor's strings are removed from every document with the phrase; literals
only from those that repeat the phrase after its first document.

Defined cases: NULL, empty and short texts (under 13 words) have no window and
lose nothing; NULL ids sort first; rows that repeat an id do not count as
earlier than each other; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from vialflow.llm import repeats
from vialflow.llm.common import WORD, materialise, prepare, read, register

UNIT = repeats.WORDS


class Reference:
    """Phrases laid end to end, and for every string of ``length`` words the
    place where its first document has it (-1 where no string starts)."""

    def __init__(self, words: np.ndarray, sizes: np.ndarray, docs: np.ndarray, length: int = UNIT.length):
        self.words, self.length = words, length
        self.stop = np.cumsum(sizes)
        self.start = self.stop - sizes
        self.phrase = np.repeat(np.arange(len(sizes)), sizes)
        self.doc = docs[self.phrase]
        place = np.flatnonzero(np.arange(len(words)) + length <= self.stop[self.phrase])
        strings = [words[place + k] for k in range(length)]
        self.digests = [repeats.chain(strings, seed) for seed in (1, 2)]
        order = np.lexsort((place, self.doc[place], *self.digests))
        fresh = np.ones(len(order), bool)
        fresh[1:] = np.logical_or.reduce([d[order][1:] != d[order][:-1] for d in self.digests])
        head = np.flatnonzero(fresh)
        self.place = place
        self.first = np.full(len(words), -1, np.int64)
        self.first[place[order]] = np.repeat(place[order][head], np.diff(np.r_[head, len(order)]))

    def agree(self, at: np.ndarray, source: np.ndarray) -> np.ndarray:
        """How many words from ``at`` on agree with those from ``source`` on
        (strings at both are known to be equal), within both phrases."""
        size = np.full(len(at), self.length, np.int64)
        room = np.minimum(self.stop[self.phrase[at]] - at, self.stop[self.phrase[source]] - source)
        live = np.flatnonzero(size < room)
        while len(live):
            n = size[live]
            live = live[self.words[at[live] + n] == self.words[source[live] + n]]
            size[live] += 1
            live = live[size[live] < room[live]]
        return size


def parse(ref: Reference) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Greedy factors of every phrase against the phrases of earlier documents:
    place, size and the place copied from. All phrases advance together, one
    factor a round."""
    known = np.zeros(len(ref.words) + 1, bool)
    known[ref.place] = ref.doc[ref.first[ref.place]] < ref.doc[ref.place]
    # the next place, this one included, where a factor can start
    spot = np.where(known, np.arange(len(known)), len(ref.words))
    following = np.minimum.accumulate(spot[::-1])[::-1]
    found = []
    at, stop = ref.start, ref.stop
    while len(at):
        at = following[at]
        inside = at < stop
        at, stop = at[inside], stop[inside]
        source = ref.first[at]
        size = ref.agree(at, source)
        found.append((at, size, source))
        at = at + size - ref.length + 1      # the first string that reaches over the factor's end
    if not found:
        return (np.zeros(0, np.int64),) * 3
    return tuple(np.concatenate(c) for c in zip(*found))


def _parse_block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    phrases = repeats.whole(batches)
    if phrases is None:
        return
    raw = phrases.column("units").to_pylist()
    words = np.frombuffer(b"".join(raw), UNIT.kind)
    sizes = np.array([len(b) for b in raw], np.int64) // words.itemsize
    docs = phrases.column("ord").to_numpy()
    ref = Reference(words, sizes, docs)
    # the document that each string is taken from: its own if it is a literal
    origin = ref.doc.copy()
    place, size, source = parse(ref)
    strings = size - UNIT.length + 1
    inner = np.arange(strings.sum()) - np.repeat(np.cumsum(strings) - strings, strings)
    origin[np.repeat(place, strings) + inner] = np.repeat(ref.doc[source], strings)
    row = ref.phrase[ref.place]
    yield repeats.resolved_rows(phrases, row, ref.place - ref.start[row], ref.digests, origin[ref.place],
                                phrases.column("open").to_numpy())


def _resolve(phrases: DataFrame, n: int) -> DataFrame:
    runs = materialise(repeats.dealt(phrases, n).mapInArrow(_parse_block, repeats.RESOLVED), "factor-runs")
    return repeats.settle(runs)


def drop_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = True) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_words, n_removed, n_spans,
    kept_sha256`` and ``kept``, the remaining words joined by one space."""
    runs = repeats.repeated(docs, UNIT, _resolve, id_col, text_col)
    return repeats.strip(docs, runs, True, UNIT.length, id_col, text_col, with_text).withColumnRenamed("n_units", "n_words")


_SQL = f"""
with raw as (select doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') as w from documents),
words as (select doc_id, unnest(w) as x, generate_subscripts(w, 1) as p from raw),
strings as (
  select doc_id, p, md5_number(array_to_string(list(x) over win, ' ')) as s, count(*) over win as n from words
  window win as (partition by doc_id order by p rows between current row and 12 following)),
first as (select s, min(doc_id) as d from strings where n = 13 group by s),
hits as (select doc_id, p from strings join first using (s) where n = 13 and doc_id > d),
gone as (select distinct doc_id, p + o as p from hits, range(13) r(o)),
kept as (
  select words.*, gone.p is not null as out from words
  left join gone on words.doc_id = gone.doc_id and words.p = gone.p),
per as (
  select doc_id, count(*) filter (out) as n_removed, coalesce(string_agg(x, ' ' order by p) filter (not out), '') as rest
  from kept group by doc_id)
select raw.doc_id, len(w)::bigint as n_words, coalesce(n_removed, 0)::bigint as n_removed,
  sha256(coalesce(rest, '')) as kept_sha256
from raw left join per using (doc_id)
"""


@register("op8_relative_lz_dedup", _SQL)
def op8_relative_lz_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document in 13-word strings of earlier documents."""
    prepare(spark)
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return drop_spans(docs, with_text=False).select("doc_id", "n_words", "n_removed", "kept_sha256")
