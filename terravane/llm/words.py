"""Words of Arrow string columns as numpy arrays: where they start and end, and 64-bit hashes of them."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Texts are taken in pieces of about this many bytes, which bounds the arrays of one step.
PIECE = 1 << 21

#: Words of more bytes are left to a cryptographic hash, one by one.
HUGE = 4096
_MASKS = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def table(keep) -> np.ndarray:
    """A byte table: bytes that keep(byte) maps to another or the same byte; 0 ends a word."""
    return np.array([keep(b) for b in range(256)], np.uint8)


#: Words are runs of everything but white space, as they are; UTF-8 has no byte 255, which stands for byte 0 here.
PLAIN = table(lambda b: 0 if b == 32 or 9 <= b <= 13 else (b or 255))


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column, and where each text starts (one more entry than texts); null is empty."""
    column = column.cast(pa.large_string()).fill_null("")
    ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, ends - ends[0]


def pieces(column: pa.Array, size: int = PIECE) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about size bytes, one row at least."""
    ends = flat(column)[1]
    at = 0
    while at < len(column):
        to = max(at + 1, int(np.searchsorted(ends, ends[at] + size, "right")) - 1)
        yield at, to
        at = to


def spans(mapped: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word of mapped bytes, and for each text the number of its first word."""
    inside = mapped != 0
    before = np.empty_like(inside)
    before[1:] = inside[:-1]
    after = np.empty_like(inside)
    after[:-1] = inside[1:]
    if len(inside):
        before[0] = after[-1] = False
    cuts = texts[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(inside))]
    before[cuts] = False
    after[cuts - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, texts)


def hashes(mapped: np.ndarray, starts: np.ndarray, ends: np.ndarray, salt: int = 0) -> np.ndarray:
    """A 64-bit hash of each word, equal for equal words wherever they stand; other salts give other hashes.

    Eight bytes at a time go through a finaliser. Words of up to eight bytes have different hashes always, and no
    pattern within longer ones makes them meet.
    """
    padded = np.zeros(len(mapped) + 8, np.uint8)
    padded[: len(mapped)] = mapped
    eight = np.ndarray((len(mapped) + 1,), "<u8", padded, strides=(1,))  # the eight bytes from each place on
    n = ends - starts
    out = mix((eight[starts] & _MASKS[np.minimum(n, 8)]) ^ np.uint64(0xA24BAED4963EE407 * (2 * salt + 1) % (1 << 64)))
    more, k = np.flatnonzero(n > 8), 8
    while len(more) and k < HUGE:
        part = eight[starts[more] + k] & _MASKS[np.minimum(n[more] - k, 8)]
        out[more] = mix(out[more] * np.uint64(0x9FB21C651E98DF25) + part)
        k += 8
        more = more[n[more] > k]
    for i in more.tolist():
        out[i] = int.from_bytes(hashlib.blake2b(mapped[starts[i] : ends[i]].tobytes(), digest_size=8, key=salt.to_bytes(4, "little")).digest(), "little")
    return out


def mix(x: np.ndarray) -> np.ndarray:
    """A finaliser that spreads every bit of a 64-bit hash."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))
