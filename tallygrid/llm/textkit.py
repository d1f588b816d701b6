"""Whole-text helpers over Arrow batches: byte buffers, words, rolling hashes, slices of bounded size.

All functions work on the UTF-8 bytes of many texts at once, so one numpy call
covers thousands of documents; nothing here looks at a prefix of a text only.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20

#: White space of the word rule (space and 0x09-0x0D).
SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)

_U = np.uint64
_ROLL = _U(0x9E3779B97F4A7C15 | 1)
_ROLL_INVERSE = _U(pow(int(_ROLL), -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (two multiply-xorshift rounds)."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_BYTE_CODES = mix(np.arange(1, 257, dtype=_U) * _U(0xD1342543DE82EF95))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IS_SPACE = np.zeros(256, bool)
IS_SPACE[list(SPACES)] = True
#: Words of the alphanumeric rule: 0-9, a-z and every byte of a character beyond ASCII.
IS_ALNUM = np.zeros(256, bool)
IS_ALNUM[48:58] = IS_ALNUM[97:123] = IS_ALNUM[128:] = True

_powers: dict[str, np.ndarray] = {}


def _power_table(name: str, base: np.uint64, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, kept between calls up to a bounded length."""
    have = _powers.get(name)
    if have is None or len(have) < n:
        steps = np.full(max(n, SLICE_BYTES + (1 << 18)), base, _U)
        steps[0] = 1
        have = np.multiply.accumulate(steps)
        _powers[name] = have if len(have) <= 4 * SLICE_BYTES else have[: 4 * SLICE_BYTES].copy()
    return have[:n]


class Bytes:
    """The texts of one slice as one byte buffer with document offsets (null counts as empty)."""

    def __init__(self, texts: pa.Array | pa.ChunkedArray, lower: bool = False):
        if isinstance(texts, pa.ChunkedArray):
            texts = texts.combine_chunks() if texts.num_chunks != 1 else texts.chunk(0)
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        n = len(texts)
        _, offsets, data = texts.buffers()
        self.offsets = np.frombuffer(offsets, np.int64, n + 1, texts.offset * 8).copy() if n else np.zeros(1, np.int64)
        start, end = self.offsets[0], self.offsets[-1]
        raw = np.frombuffer(data, np.uint8)[start:end] if end > start else np.zeros(0, np.uint8)
        self.offsets -= start
        self.data = LOWER[raw] if lower else raw

    @property
    def docs(self) -> int:
        return len(self.offsets) - 1

    def starts_document(self) -> np.ndarray:
        """A mark at the first byte of every document that is not empty."""
        mark = np.zeros(len(self.data) + 1, bool)
        mark[self.offsets] = True
        return mark

    def words(self, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, end and document of every maximal run of word bytes; runs end at documents' ends."""
        inside = np.zeros(len(self.data) + 2, bool)
        inside[1:-1] = is_word[self.data]
        border = self.starts_document()
        before, here = inside[:-1], inside[1:]
        starts = np.flatnonzero(here & (~before | border))
        ends = np.flatnonzero(before & (~here | border))
        return starts, ends, self.document_of(starts)

    def document_of(self, positions: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.offsets, positions, side="right") - 1

    def prefix(self) -> np.ndarray:
        """Running polynomial sums; ``span_hash`` turns them into hashes of byte ranges."""
        out = np.zeros(len(self.data) + 1, _U)
        np.cumsum(_BYTE_CODES[self.data] * _power_table("up", _ROLL, len(self.data)), out=out[1:])
        return out


_LETTERS = np.full(256, 32, np.uint8)
_LETTERS[97:123] = np.arange(97, 123)
_LETTERS[65:91] = np.arange(97, 123)
_LETTERS[128:] = np.arange(128, 256)


def letter_grams(text: Bytes, length: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash buckets of byte n-grams of lower-cased letters, in text order, and how many each document has.

    Runs of other characters count as one border character, n-grams do not cross
    them, and ``buckets`` is a power of two.
    """
    data = _LETTERS[text.data]
    n = len(data) - length + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(text.docs, np.int64)
    border = data == 32
    keep = np.ones(n, bool)
    for cut in range(1, length):
        at = text.offsets[1:-1] - cut
        keep[at[(at >= 0) & (at < n)]] = False
    if length <= 2:
        keep &= ~(border[:n] & border[length - 1:])
    for inner in range(1, length - 1):
        keep &= ~border[inner:n + inner]
    h = np.full(n, 2166136261 + length, np.uint32)
    for i in range(length):
        h = (h ^ data[i:n + i]) * np.uint32(16777619)
    at = np.flatnonzero(keep)
    h = h[at]
    h = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    return ((h ^ (h >> np.uint32(13))) & np.uint32(buckets - 1)).astype(np.int64), \
        np.diff(np.searchsorted(at, text.offsets))


def span_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte ranges [start, end): equal bytes give equal hashes wherever they stand."""
    down = _power_table("down", _ROLL_INVERSE, len(prefix))
    return mix((prefix[ends] - prefix[starts]) * down[starts] + (ends - starts).astype(_U))


def distinct(keys: np.ndarray) -> np.ndarray:
    """Sorted distinct numbers, by sorting: ``np.unique`` builds a table of them, which takes longer."""
    keys = np.sort(keys)
    return keys[np.concatenate([[True], keys[1:] != keys[:-1]])] if len(keys) else keys


def shingle_hash(words: np.ndarray, width: int) -> np.ndarray:
    """Hashes of ``width`` consecutive word hashes, one per start position."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, _U)
    out = np.zeros(n, _U)
    for i in range(width):
        out = out * _ROLL + words[i:i + n]
    return mix(out)


def slices(batches: Iterable[pa.RecordBatch], text: str = "text",
           limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that a slice holds about ``limit`` bytes of text, one document at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(text))), 0)
        total = np.cumsum(size.to_numpy(zero_copy_only=False).astype(np.int64))
        start, done = 0, 0
        while start < batch.num_rows:
            end = max(start + 1, int(np.searchsorted(total, done + limit, side="right")))
            yield batch.slice(start, end - start)
            start, done = end, int(total[end - 1])


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as one value of a binary column."""
    head = np.array([len(arrays), *[len(a) for a in arrays]], np.int64)
    kinds = "".join(a.dtype.str.ljust(4) for a in arrays).encode()
    return head.tobytes() + kinds + b"".join(np.ascontiguousarray(a).tobytes() for a in arrays)


def unpack(blob: bytes) -> list[np.ndarray]:
    n = int(np.frombuffer(blob, np.int64, 1)[0])
    lengths = np.frombuffer(blob, np.int64, n, 8)
    kinds = bytes(blob[8 + 8 * n:8 + 12 * n]).decode()
    at, out = 8 + 12 * n, []
    for i in range(n):
        kind = np.dtype(kinds[4 * i:4 * i + 4].strip())
        out.append(np.frombuffer(blob, kind, int(lengths[i]), at))
        at += int(lengths[i]) * kind.itemsize
    return out


def planes(keys: np.ndarray) -> np.ndarray:
    """Sorted keys as differences, byte by byte of equal rank, so that the leading zeros pack well."""
    gaps = np.diff(keys, prepend=np.uint64(0))
    return np.ascontiguousarray(gaps.view(np.uint8).reshape(-1, 8).T).ravel()


def from_planes(data: np.ndarray) -> np.ndarray:
    return np.cumsum(np.ascontiguousarray(data.reshape(8, -1).T).view(np.uint64).ravel(), dtype=np.uint64)


def byte_planes(values: np.ndarray) -> np.ndarray:
    """Small numbers byte by byte of equal rank."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(-1, values.itemsize).T).ravel()


def from_byte_planes(data: np.ndarray, kind: type) -> np.ndarray:
    return np.ascontiguousarray(data.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()
