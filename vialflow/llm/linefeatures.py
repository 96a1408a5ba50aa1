"""Measures of every line of a batch of texts, vectorised over its bytes.

A text is cut at ``\\n`` into lines (an empty text is one empty line). Each line
gets ``N_OWN`` numbers from byte classes, words (runs of bytes other than
space and control whitespace) and repetition inside its document; ``emissions``
adds those of the lines before and after. Nothing here looks at ids or labels.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Byte classes, one bit each.
_CLASSES = (
    b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"|", b"#*$%&<>@\\^_~=+{}[]", b"!?", b".,;:",
    b"'\"()-/`", bytes(range(128, 256)))
_GAP = np.zeros(256, bool)
_GAP[[9, 10, 11, 12, 13, 32]] = True
_MULT = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)

N_OWN = 21
#: Numbers per line with both neighbours, edge marks and a constant.
N_ALL = 3 * N_OWN + 3
#: Bytes of text that are measured together (one text at least).
CHUNK = 1 << 20


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MIX
    return x ^ (x >> np.uint64(29))


def _span_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of ``data``."""
    with np.errstate(over="ignore"):
        power = np.cumprod(np.full(len(data) + 1, _MULT, np.uint64))
        total = np.concatenate([[np.uint64(0)], np.cumsum(_mix(data.astype(np.uint64) + np.uint64(1)) * power[:-1])])
        # moved to a common power: spans that start later are multiplied by less
        return _mix((total[ends] - total[starts]) * power[len(data) - starts] + (ends - starts).astype(np.uint64))


def _seen_before(doc: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Whether an equal key stands earlier in the same document."""
    with np.errstate(over="ignore"):
        both = _mix(key + doc.astype(np.uint64) * _MULT)
    order = np.argsort(both, kind="stable")
    same = np.concatenate([[False], both[order][1:] == both[order][:-1]])
    out = np.zeros(len(both), bool)
    out[order] = same
    return out


def _per_line(marks: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Sum of ``marks`` between consecutive edges."""
    total = np.concatenate([[0], np.cumsum(marks, dtype=np.int64)])
    return (total[edges[1:]] - total[edges[:-1]]).astype(float)


def _measure(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(line numbers x N_OWN, length of each line, lines of each text)."""
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    stops = np.flatnonzero(data == 10)
    edges = np.concatenate([[0], stops + 1])  # a line with its line end
    n_lines = np.array([t.count(b"\n") + 1 for t in texts])
    doc = np.repeat(np.arange(len(texts)), n_lines)
    size = np.diff(edges) - 1.0
    chars = np.maximum(size, 1.0)
    lut = np.zeros((len(_CLASSES), 256), bool)
    for i, members in enumerate(_CLASSES):
        lut[i, list(members)] = True
    share = [_per_line(lut[i][data], edges) / chars for i in range(len(_CLASSES))]

    gap = _GAP[data]
    begins = np.flatnonzero(~gap & np.concatenate([[True], gap[:-1]]))
    finish = np.flatnonzero(~gap & np.concatenate([gap[1:], [True]])) + 1
    line = np.searchsorted(stops, begins)
    n_words = np.bincount(line, minlength=len(size)).astype(float)
    per_word = np.maximum(n_words, 1.0)
    length = finish - begins
    last = data[finish - 1]
    ends_odd = lut[3][last] | lut[4][last] | lut[5][last]
    word = _span_hash(data, begins, finish)
    with np.errstate(over="ignore"):
        pair = _mix(word + np.roll(word, -1) * _MULT)
        three = _mix(pair + np.roll(word, -2) * _MIX)
    inside = np.zeros(len(word), bool)  # a window that stays in its text
    if len(word) > 2:
        inside[:-2] = doc[line][2:] == doc[line][:-2]
    with np.errstate(over="ignore"):
        three = np.where(inside, three, np.arange(len(word), dtype=np.uint64) * _MULT + np.uint64(1))
    again = _seen_before(doc[line], three) & inside
    twice = np.concatenate([[False], (word[1:] == word[:-1]) & (line[1:] == line[:-1])])[:len(word)]
    count = lambda marks: np.bincount(line[marks], minlength=len(size)) / per_word
    copy = _seen_before(doc, _span_hash(data, edges[:-1], stops)) & (n_words > 0)
    total = np.bincount(doc, n_words)[doc]
    own = [*share, np.log1p(n_words), np.log1p(total), count(length <= 2), count(length >= 12), count(ends_odd), count(again),
           count(twice), np.bincount(line, length, len(size)) / per_word / 8.0, copy.astype(float),
           (n_words == 0).astype(float), (n_words < 4).astype(float), np.minimum(total / 50.0, 1.0)]
    return np.column_stack(own), size, n_lines


def chunks(texts: list[bytes]) -> Iterator[list[bytes]]:
    """The texts in runs of bounded size."""
    run, size = [], 0
    for t in texts:
        if run and size + len(t) > CHUNK:
            yield run
            run, size = [], 0
        run.append(t)
        size += len(t)
    if run:
        yield run


def emissions(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a row of ``N_ALL`` numbers per line, length of each line, lines of each
    text): a line's numbers, those of its neighbours, edge marks, a constant."""
    own, size, n_lines = _measure(texts)
    ends = np.cumsum(n_lines)
    first, last = np.zeros(len(own)), np.zeros(len(own))
    first[ends - n_lines], last[ends - 1] = 1.0, 1.0
    before, after = np.roll(own, 1, 0) * (1 - first)[:, None], np.roll(own, -1, 0) * (1 - last)[:, None]
    return np.column_stack([own, before, after, first, last, np.ones(len(own))]), size, n_lines
