"""Words and word-sequence hashes of many texts at once, in numpy.

The functions work on a block of texts joined into one byte buffer, so their
cost is a few vector passes per block instead of Python work per word. They run
inside Spark tasks (``mapInArrow``); blocks are cut by size, never texts.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes of text handled in one numpy pass (a longer text gets a pass of its own).
BLOCK_BYTES = 4 << 20

_C1 = np.uint64(0xBF58476D1CE4E5B9)
_C2 = np.uint64(0x94D049BB133111EB)
_GOLD = np.uint64(0x9E3779B97F4A7C15)
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def _word_bytes(*gaps: tuple[int, int]) -> np.ndarray:
    """Table of 256 flags: True where a byte belongs to a word."""
    flags = np.ones(256, bool)
    for lo, hi in gaps:
        flags[lo:hi + 1] = False
    return flags


#: Words are runs without ASCII white space (space, tab to carriage return).
SPACED = _word_bytes((0x20, 0x20), (0x09, 0x0D))
#: Words are runs of digits, lower-case letters and non-ASCII characters.
ALNUM = _word_bytes((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * _C1
    x ^= x >> np.uint64(27)
    x *= _C2
    x ^= x >> np.uint64(31)
    return x


def join_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of the sequence (a, b), element by element."""
    return mix(a * _GOLD + b)


@dataclass
class Words:
    """The words of a block of texts, in order."""

    buf: bytes          # the texts, each followed by one separator byte
    starts: np.ndarray  # byte offset of each word
    ends: np.ndarray    # byte offset after each word
    first: np.ndarray   # index of each text's first word; one more entry at the end

    def __len__(self) -> int:
        return len(self.starts)

    def hashes(self) -> np.ndarray:
        """64-bit hash of each word's bytes, eight bytes at a time."""
        raw = np.frombuffer(self.buf + b"\0" * 8, np.uint8)
        eight = np.ndarray((len(raw) - 7,), "<u8", raw, 0, (1,))
        left = self.ends - self.starts
        h = mix(left.astype(np.uint64) * _GOLD)
        at, todo = self.starts, None
        while True:
            part = eight[at]
            short = left < 8
            if short.any():
                keep = (np.uint64(8) - left[short].astype(np.uint64)) << np.uint64(3)
                part[short] = (part[short] << keep) >> keep
            if todo is None:
                h = mix((h ^ part) + _GOLD)
            else:
                h[todo] = mix((h[todo] ^ part) + _GOLD)
            more = np.flatnonzero(left > 8)
            if not len(more):
                return h
            todo = more if todo is None else todo[more]
            left, at = left[more] - 8, at[more] + 8

    def text_of(self) -> np.ndarray:
        """Index of the text that each word belongs to."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def joined(self) -> tuple[bytes, np.ndarray]:
        """All words joined by one space, and each word's offset there (plus the end)."""
        raw = np.frombuffer(self.buf, np.uint8)
        delta = np.zeros(len(raw) + 1, np.int8)
        delta[self.starts] = 1
        delta[self.ends + 1] -= 1  # a word's run takes the byte after it along
        keep = np.cumsum(delta[:-1], dtype=np.int8).astype(bool)
        out = raw[keep]
        size = self.ends - self.starts + 1
        at = np.concatenate(([0], np.cumsum(size)))
        out[at[1:] - 1] = 32
        return out.tobytes(), at


def split_words(texts: Iterable[bytes | None], word: np.ndarray = SPACED,
                lower: bool = False) -> Words:
    """The words of ``texts`` (None counts as empty). ``word``: flags by byte;
    a line feed must not be a word byte, it separates the texts."""
    parts = [t or b"" for t in texts]
    buf = b"\n".join(parts) + b"\n"
    if lower:
        buf = buf.translate(_LOWER)
    inside = np.zeros(len(buf) + 2, np.int8)
    inside[1:-1] = word[np.frombuffer(buf, np.uint8)]
    edge = np.diff(inside)
    starts = np.flatnonzero(edge == 1)
    ends = np.flatnonzero(edge == -1)
    size = np.fromiter((len(p) + 1 for p in parts), np.int64, len(parts))
    bounds = np.concatenate(([0], np.cumsum(size)))
    return Words(buf, starts, ends, np.searchsorted(starts, bounds))


def sequence_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of the ``n`` values from each position on (``len(h) - n + 1`` of them),
    composed from runs of 1, 2, 4, ... values."""
    total = len(h) - n + 1
    if total <= 0:
        return np.zeros(0, np.uint64)
    out, done, run, size = None, 0, h, 1
    left = n
    while left:
        if left & 1:
            piece = run[done:done + total]
            out = mix(piece + np.uint64(size)) if out is None else join_hash(out, piece)
            done += size
        left >>= 1
        if left:
            run = join_hash(run[:-size], run[size:])
            size *= 2
    return out


def sliding_min(v: np.ndarray, n: int) -> np.ndarray:
    """Minimum of the ``n`` values from each position on."""
    size = 1
    total = len(v) - n + 1
    while size * 2 <= n:
        v = np.minimum(v[:-size], v[size:])
        size *= 2
    return np.minimum(v[:total], v[n - size:n - size + total])


def inside_text(words: Words, n: int) -> np.ndarray:
    """Flags: the ``n`` words from this word on belong to one text."""
    last = np.repeat(words.first[1:], np.diff(words.first))
    return np.arange(len(words)) + n <= last


def runs(flags: np.ndarray, *same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of set flags along which every array of ``same`` is constant:
    index of the first element and length of each run."""
    on = np.flatnonzero(flags)
    if not len(on):
        return on, on
    cut = np.diff(on) != 1
    for s in same:
        cut |= s[on[1:]] != s[on[:-1]]
    first = np.concatenate(([0], np.flatnonzero(cut) + 1))
    size = np.diff(np.concatenate((first, [len(on)])))
    return on[first], size


def as_bytes(column: pa.Array | pa.ChunkedArray) -> list[bytes | None]:
    """A string or binary column as bytes objects."""
    return column.cast(pa.binary()).to_pylist()


def give_back() -> None:
    """Return freed memory to the system: a worker is reused by the tasks of later
    stages, which would pile up what each of them left in its heap."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim:
        trim(0)


def blocks(batches: Iterable[pa.RecordBatch], column: str,
           limit: int = BLOCK_BYTES) -> Iterator[pa.Table]:
    """Regroup record batches into tables whose ``column`` holds about ``limit``
    bytes (one row at least); no row is dropped or cut."""
    held, size = [], 0
    give_back()
    for batch in batches:
        if not batch.num_rows:
            continue
        lens = np.asarray(batch.column(column).cast(pa.binary()).fill_null(b"")
                          .to_numpy(zero_copy_only=False), object)
        total = np.cumsum(np.fromiter((len(x) for x in lens), np.int64, len(lens)))
        begin = 0
        while begin < batch.num_rows:
            base = total[begin - 1] if begin else 0
            end = max(int(np.searchsorted(total, base + limit - size, "right")), begin + (not held))
            if end > begin:
                held.append(batch.slice(begin, end - begin))
                size += int(total[end - 1] - base)
                begin = end
            if size >= limit or begin < batch.num_rows:
                yield pa.Table.from_batches(held)
                held, size = [], 0
                give_back()
    if held:
        yield pa.Table.from_batches(held)
