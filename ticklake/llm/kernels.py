"""Numpy kernels over whole Arrow text columns; a task's batches are cut so that their arrays stay small."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that one kernel call works on; a longer document is worked on alone.
CHUNK = 1 << 20

_U = np.uint64
_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
_LETTER = np.random.default_rng(20260101).integers(1, 2**63, 256, dtype=np.uint64) | _U(1)
_BASE = 0x9E3779B97F4A7C15


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values (the finaliser of splitmix64)."""
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def text_column(column: pa.Array) -> pa.Array:
    """The column as 64-bit-offset binary without nulls (null: empty)."""
    return pc.fill_null(column.cast(pa.large_binary()), b"")


def byte_sizes(column: pa.Array) -> np.ndarray:
    return np.diff(np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1])


def chunks(column: pa.Array, limit: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Ranges of rows with up to ``limit`` bytes, or one row."""
    sizes = byte_sizes(column)
    at = 0
    while at < len(sizes):
        upto = np.cumsum(sizes[at : at + 65536])
        n = max(1, int(np.searchsorted(upto, limit, side="right")))
        yield at, at + n
        at += n


def joined(column: pa.Array, at: int, to: int, gap: bytes = b" ") -> tuple[np.ndarray, np.ndarray]:
    """The bytes of rows at..to with ``gap`` between them, and where each row starts (one more entry: the end)."""
    rows = column.slice(at, to - at)
    sizes = byte_sizes(rows)
    data = gap.join([*rows.to_pylist(), b""])
    starts = np.concatenate(([0], np.cumsum(sizes + len(gap))))
    return np.frombuffer(data, np.uint8), starts


def words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each word of the bytes starts and ends."""
    inside = np.concatenate(([False], ~_SEPARATOR[data], [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[::2], edges[1::2]


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, salt: int = 0) -> np.ndarray:
    """A 64-bit hash of each word's bytes, the same wherever the word stands.

    The sum of a mixed value for each (byte, place in the word): no polynomial,
    whose structure would give long words of two letters equal values. Another
    ``salt`` gives an independent hash.
    """
    length = ends - starts
    if not len(length):
        return np.zeros(0, np.uint64)
    first = np.cumsum(length) - length
    place = np.arange(int(length.sum()))
    at = place + np.repeat(starts - first, length)
    place -= np.repeat(first, length)
    terms = mix(_LETTER[data[at]] + place.astype(np.uint64) * _U(_BASE) + _U(salt * 0x632BE59BD9B4E019 & (1 << 64) - 1))
    return mix(np.add.reduceat(terms, first) + length.astype(np.uint64))


def doubled(names: np.ndarray, length: int, have: int = 1) -> np.ndarray:
    """Names of all runs of ``length`` from names of runs of ``have``, by prefix doubling: two overlapping runs name a longer one."""
    while have < length:
        step = min(have, length - have)
        names = mix(names[:-step] * _U((_BASE * (2 * step + 1)) & (2**64 - 1) | 1) + (names[step:] ^ _U(0xD6E8FEB86659FD93)))
        have += step
    return names


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The least value of each run of ``width``."""
    have = 1
    while have < width:
        step = min(have, width - have)
        values = np.minimum(values[:-step], values[step:])
        have += step
    return values


def per_doc(position: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """How many of the sorted positions lie before each of ``starts``: bounds of each document's share."""
    return np.searchsorted(position, starts)


#: Units (bytes or words) of a text that one call of ``anchored`` takes; texts are cut with an overlap of a window.
UNITS = 1 << 21
_POSITION = _U((1 << 22) - 1)


def anchored(values: np.ndarray, bounds: np.ndarray, window: int, anchor: int) -> tuple[np.ndarray, ...]:
    """Groups of neighbouring windows that share their anchor: (row, start, count, name, digest).

    ``values``: a 64-bit value of each unit; ``bounds``: where each row's units
    start. A window's anchor is the leftmost of its runs of ``anchor`` units with
    the least name, so equal windows have the same anchor at the same place.
    ``name`` is the anchor's name, ``digest`` one of all units under the group,
    made of the doubled names of its first and last window.
    """
    none = (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),) * 2
    if len(values) < window:
        return none
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    whole = row[: len(values) - window + 1] == row[window - 1 :]
    names = doubled(values, anchor)
    least = sliding_min((names & ~_POSITION) | np.arange(len(names), dtype=np.uint64), window - anchor + 1) & _POSITION
    edge = whole.copy()
    edge[1:] &= (least[1:] != least[:-1]) | ~whole[:-1]
    start = np.flatnonzero(edge)
    if not len(start):
        return none
    ends = np.flatnonzero(whole & np.concatenate((~whole[1:] | edge[1:], [True]))) + 1
    stop = ends - 1  # the last window; a group's windows all hold its anchor, so the first and the last cover every unit
    runs = doubled(names, window, anchor)
    digest = mix(runs[start] * _U(_BASE) + (runs[stop] ^ _U(0xA5A5A5A5A5A5A5A5)) + (stop - start).astype(np.uint64))
    return row[start], start - bounds[row[start]], ends - start, names[least[start].astype(np.int64)], digest


def cut_rows(bounds: np.ndarray, window: int) -> list[tuple[int, int, int, int]]:
    """(first row, last row, first unit, last unit) of the parts that ``anchored`` works on; a long row comes in overlapping parts."""
    parts, at, rows = [], 0, len(bounds) - 1
    while at < rows:
        to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + UNITS, side="right")) - 1)
        if to == at + 1:
            a, b = int(bounds[at]), int(bounds[to])
            parts += [(at, to, x, min(b, x + UNITS)) for x in range(a, max(a + 1, b - window + 1), UNITS - window + 1)]
        else:
            parts.append((at, to, int(bounds[at]), int(bounds[to])))
        at = to
    return parts


def groups(values: np.ndarray, bounds: np.ndarray, window: int, anchor: int) -> tuple[np.ndarray, ...]:
    """``anchored`` over any number of rows of any length."""
    found = []
    for first, last, a, b in cut_rows(bounds, window):
        row, start, count, name, digest = anchored(values[a:b], np.clip(bounds[first : last + 1], a, b) - a, window, anchor)
        if last == first + 1:
            start = start + (a - bounds[first])
        found.append((row + first, start, count, name, digest))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else anchored(values[:0], np.zeros(1, np.int64), window, anchor)


def word_values(data: np.ndarray, starts: np.ndarray, salt: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word of joined rows, and where each row's words start."""
    first, last = words(data)
    return word_hashes(data, first, last, salt), np.searchsorted(first, starts)
