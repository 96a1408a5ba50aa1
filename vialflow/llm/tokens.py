"""Exact tokenisation of whole texts with a public tokenizer file.

Prose repeats its words, so a text is cut before single spaces and before line
feeds, where every public vocabulary here starts a new piece, and each distinct
piece is encoded once per worker; most come from a dictionary. Punctuation after
a letter or digit is a piece of its own too. Plain words go to the tokenizer's model
directly if probes show that this equals its full path. Texts with other white
space, runs of spaces or special-token marks are encoded whole. The ids equal
those of ``Tokenizer.encode(text, add_special_tokens=False)``.
"""

from __future__ import annotations

import os
import re
import sys
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: What rules out cutting at spaces: other white space and separators, runs
#: that hold a space, special-token marks. Substring tests are far faster than
#: one expression here.
_ODD_ASCII = ("  ", " \n", "\n ", "<|", *map(chr, (0, 9, 11, 12, 13, 28, 29, 30, 31)))
_ODD = tuple(map(chr, (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))


def _whole(t: str) -> bool:
    """Whether a text must be encoded in one piece."""
    if not t or t[0] == " " or t[-1] == " " or any(x in t for x in _ODD_ASCII):
        return True
    return not t.isascii() and any(x in t for x in _ODD)


_FEEDS = re.compile(r"\n+").sub
#: Pieces kept per worker (memory only): later ones, which are rare, are
#: encoded whenever they occur.
_KNOWN = 300_000
_LONG = 64
#: ASCII punctuation but the apostrophe: a run of it after a letter or digit
#: is a piece of its own in both vocabularies.
_MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
#: Bytes of text that are encoded in one go.
_STEP = 3 << 20
_ENCODERS: dict = {}


def _byte_letters() -> list[str]:
    """The letter that byte-level vocabularies write for each byte: printable
    Latin-1 as itself, the others from code point 256 on in ascending order."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b if b in plain else next(others)) for b in range(256)]


def _strings(a: pa.Array) -> list[str]:
    """Strings without spaces as a list: one join and one split are many times
    faster than ``to_pylist``."""
    if not len(a):
        return []
    a = a.cast(pa.large_string())
    return pc.binary_join(pa.LargeListArray.from_arrays([0, len(a)], a), pa.scalar(" ", a.type))[0].as_py().split(" ")


class Encoder:
    """Texts to little-endian ids of ``width`` bytes each."""

    def __init__(self, path: str, width: int = 4):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.model = self.tok.model
        self.kind = np.dtype(f"<u{width}")
        self.code = {2: "H", 4: "I"}[width]
        if sys.byteorder != "little":
            raise RuntimeError("ids are written in the machine's order, which must be little-endian")
        if self.tok.get_vocab_size() > 256 ** width:
            raise ValueError(f"ids of {path} do not fit {width} bytes")
        # word after a space, line feeds and a word, or NUL and a text's first word -> ids
        self.known: dict[str, bytes] = {}
        self.stops: dict[str, bytes] = {}
        self.letters = _byte_letters()
        probes = ["the", "Hello", "worthless", "na\u00efve", "\u00c9t\u00e9", "Stra\u00dfe", "x"]
        self.spell = next((spell for spell in (self._spaced, self._lower) if all(
            self._plain(spell(p)) == self._full([" " + p])[0] for p in probes)), None)
        self.feed = self._full(["\n"])[0]
        if self.spell and any(self.feed + self._plain(self._bare(p)) != self._full(["\n" + p])[0] for p in probes):
            self.spell = None

    def _spaced(self, word: str) -> str:
        if word.isascii():
            return self.letters[32] + word
        return "".join([self.letters[b] for b in (" " + word).encode()])

    def _bare(self, word: str) -> str:
        """A word that follows no space, as the vocabulary spells it."""
        spelt = self.spell(word)
        return spelt[1:] if self.spell == self._spaced else spelt

    def _lower(self, word: str) -> str:
        if word.isascii():
            return word.lower()
        return "".join([self.letters[b] for b in word.lower().encode()])

    def _plain(self, spelt: str) -> bytes:
        return array(self.code, [t.id for t in self.model.tokenize(spelt)]).tobytes()

    def _full(self, texts: list[str]) -> list[bytes]:
        return [array(self.code, e.ids).tobytes() for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, stems: list[str]) -> None:
        """Learn words that follow a space, line feeds with a word, and first words."""
        known, spell, tokenize, code, odd = self.known, self.spell, self.model.tokenize, self.code, []
        for w in stems:
            if spell and w.isalpha() and (w.isascii() or max(w) < "\u0100"):
                known[w] = array(code, [t.id for t in tokenize(spell(w))]).tobytes()
            elif spell and w[:1] == "\n" and w[1:].isalpha() and (w.isascii() or max(w) < "\u0100"):
                known[w] = self.feed + self._plain(self._bare(w[1:]))
            else:
                odd.append(w)
        if odd:
            known.update(zip(odd, self._full([w[1:] if w[0] == "\0" else w if w[0] == "\n" else " " + w for w in odd])))

    def _ids_of(self, pieces: pa.Array) -> list[bytes]:
        """Ids of distinct pieces: a run of marks after a word is taken off, so
        that a word is learned once whatever follows it."""
        stem = pc.utf8_rtrim(pieces, _MARKS)
        run = pc.subtract(pc.binary_length(pieces), pc.binary_length(stem))
        cut = pc.and_(pc.greater(run, 0), pc.utf8_is_alnum(stem))
        stems = pc.if_else(cut, stem, pieces).dictionary_encode()
        words, known, stops = _strings(stems.dictionary), self.known, self.stops
        ids = list(map(known.get, words))
        missing = [i for i, b in enumerate(ids) if b is None]
        before = len(known)
        self._learn([words[i] for i in missing])
        for i in missing:
            ids[i] = known[words[i]]
        # the newest entries go first, as dictionaries keep their order
        for _ in range(len(known) - max(before, _KNOWN)):
            known.popitem()
        for i in missing:
            if len(words[i]) > _LONG:
                known.pop(words[i], None)
        out = [ids[i] for i in stems.indices.to_numpy().tolist()]
        length = run.to_numpy(zero_copy_only=False) * cut.to_numpy(zero_copy_only=False)
        for n in np.unique(length[length > 0]).tolist():
            at = np.flatnonzero(length == n)
            runs = _strings(pc.utf8_slice_codeunits(pieces.take(pa.array(at)), start=-n))
            new = sorted(set(runs).difference(stops))
            stops.update(zip(new, self._full(new)) if new else ())
            for i, r in zip(at.tolist(), runs):
                out[i] += stops[r]
        if len(stops) > _KNOWN // 8:
            stops.clear()
        return out

    def _pieces(self, texts: list[str]) -> list[bytes]:
        """Ids of texts that may be cut: split, look up the distinct pieces,
        and gather their ids for all places at once."""
        cut = ["\0" + (_FEEDS(r" \g<0>", t) if "\n\n" in t else t.replace("\n", " \n")) for t in texts]
        lists = pc.split_pattern(pa.array(cut, pa.large_string()), " ")
        flat = lists.flatten().dictionary_encode()
        code, ids = flat.indices.to_numpy(), self._ids_of(flat.dictionary)
        sizes = np.fromiter(map(len, ids), np.int32, len(ids)) // self.kind.itemsize
        store, start = np.frombuffer(b"".join(ids), self.kind), np.cumsum(sizes, dtype=np.int32) - sizes
        n = sizes[code]
        stop = np.cumsum(n)
        at = np.repeat(start[code] - (stop - n).astype(np.int32), n)
        at += np.arange(len(at), dtype=np.int32)
        out = store[at]
        edge = np.concatenate([[0], stop])[lists.offsets.to_numpy()].tolist()
        return [out[a:b].tobytes() for a, b in zip(edge, edge[1:])]

    def encode(self, texts: list[str]) -> list[bytes]:
        out: list[bytes] = [b""] * len(texts)
        at = [i for i, t in enumerate(texts) if not _whole(t)]
        odd = sorted(set(range(len(texts))).difference(at))
        for i, b in (*zip(at, self._pieces([texts[i] for i in at]) if at else ()),
                     *zip(odd, self._full([texts[i] for i in odd]) if odd else ())):
            out[i] = b
        return out


def encoder(path: str, width: int) -> Encoder:
    """The worker's encoder for a tokenizer file, loaded once per worker."""
    if (path, width) not in _ENCODERS:
        _ENCODERS[path, width] = Encoder(path, width)
    return _ENCODERS[path, width]


def with_ids(df: DataFrame, text_col: str, path: str, end_id: int, width: int, out_col: str = "ids",
             then: Callable[[pa.RecordBatch], pa.RecordBatch] | None = None,
             schema: str | None = None) -> DataFrame:
    """``df`` with the text replaced by its ids plus ``end_id`` (binary).

    A NULL text is read as empty, so every row has at least the end id.
    ``then`` turns each batch into one of ``schema`` in the same worker.
    """
    others = [c for c in df.columns if c != text_col]
    end = np.array([end_id], f"<u{width}").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path, width)
        for batch in batches:
            size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(len(others))), 0).to_numpy())
            at = 0
            while at < batch.num_rows:
                stop = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + _STEP)))
                part, at = batch.slice(at, stop - at), stop
                ids = [b + end for b in enc.encode([t or "" for t in part.column(len(others)).to_pylist()])]
                out = pa.RecordBatch.from_arrays([*(part.column(i) for i in range(len(others))), pa.array(ids, pa.binary())],
                                                 [*others, out_col])
                yield then(out) if then else out

    own = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*others).schema.fields)
    return df.select(*others, F.col(text_col).cast("string")).mapInArrow(run, schema or f"{own}, `{out_col}` binary")


def ids32(ids: bytes, width: int) -> bytes:
    """The same ids as little-endian unsigned 32-bit integers."""
    return ids if width == 4 else np.frombuffer(ids, f"<u{width}").astype("<u4").tobytes()
