"""Words of many texts at once, as numpy arrays over one byte buffer.

Everything here works on a slice of an Arrow batch inside a task. A slice holds about ``SLICE`` bytes
of text, or one longer text, so memory follows the longest text and not the partition.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash

SLICE = 1 << 20
SPACES = b" \t\n\x0b\x0c\r"

#: Spans are hashed as polynomials modulo this prime: for a modulus of 2^64 some strings collide whatever the base.
PRIME = (1 << 61) - 1
#: Independent bases; two hashes together decide where equality removes something.
BASES = (0x0B7E151628AED2A6 % PRIME, 0x1A0F5C3D97E4B8C3 % PRIME)
#: Pieces of eight bytes of a word that are hashed in step; the rest of a longer word goes to xxh3.
PIECES = 64


def separators(keep: bytes | None = None) -> np.ndarray:
    """Which bytes separate words: white space, or all but ``keep`` and bytes over 0x7F."""
    table = np.zeros(256, dtype=bool)
    if keep is None:
        table[list(SPACES)] = True
    else:
        table[:128] = True
        table[list(keep)] = False
    return table


BY_SPACE = separators()
BY_ALNUM = separators(b"0123456789abcdefghijklmnopqrstuvwxyz")

#: bytes.translate table: A-Z to a-z, all that separates BY_ALNUM words to a space.
ALNUM_TRANSLATION = bytes(
    32 if BY_ALNUM[c] else c for c in (b + 32 if 65 <= b <= 90 else b for b in range(256))
)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def alnum_words(text: bytes | None) -> list[bytes]:
    """Runs of digits, a-z and characters over 0x7F, after A-Z became a-z. NULL has none."""
    return text.translate(ALNUM_TRANSLATION).split() if text else []


def texts_of(column: pa.Array) -> list[bytes | None]:
    return column.cast(pa.binary()).to_pylist()


def slices(texts: list[bytes | None], limit: int = SLICE) -> Iterator[tuple[int, int]]:
    """Ranges of ``texts`` that hold ``limit`` bytes at most, or one text."""
    begin = size = 0
    for i, text in enumerate(texts):
        n = len(text) if text else 0
        if size and size + n > limit:
            yield begin, i
            begin, size = i, 0
        size += n
    if begin < len(texts):
        yield begin, len(texts)


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of splitmix64: spreads every input bit over the word."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_P = np.uint64(PRIME)
_31, _30, _61 = np.uint64(31), np.uint64(30), np.uint64(61)
_LOW31, _LOW30 = np.uint64((1 << 31) - 1), np.uint64((1 << 30) - 1)


def _residue(x: np.ndarray) -> np.ndarray:
    """Unsigned 64-bit numbers modulo the prime."""
    x = (x & _P) + (x >> _61)
    return np.where(x >= _P, x - _P, x)


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products of residues modulo the prime, from halves of 30 and 31 bits."""
    a_high, a_low, b_high, b_low = a >> _31, a & _LOW31, b >> _31, b & _LOW31
    middle = a_high * b_low + a_low * b_high
    total = (a_high * b_high << np.uint64(1)) + (middle >> _30) + ((middle & _LOW30) << _31) + a_low * b_low
    return _residue(total)


_powers: dict[int, np.ndarray] = {}


def _powers_of(base: int, n: int) -> np.ndarray:
    found = _powers.get(base)
    if found is None or len(found) < n:
        found, step = np.ones(1, dtype=np.uint64), base
        while len(found) < max(n, SLICE // 4):
            found = np.concatenate([found, times(found, np.uint64(step))])
            step = step * step % PRIME
        if n <= 4 * SLICE:
            _powers[base] = found
    return found[:n]


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = 0) -> np.ndarray:
    """Hash of values[s:e] for every span, equal for equal contents wherever they stand."""
    n = len(values)
    terms = times(_residue(values), _powers_of(BASES[base], n))
    # Sums of halves fit 64 bits for 2^33 terms.
    low, high = np.zeros(n + 1, dtype=np.uint64), np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(terms & _LOW31, out=low[1:])
    np.cumsum(terms >> _31, out=high[1:])
    above = _residue(high[ends] - high[starts])
    total = ((above << _31) & _P) + (above >> _30) + _residue(low[ends] - low[starts])
    inverse = pow(BASES[base], -1, PRIME)
    return mix(times(_residue(total), _powers_of(inverse, n + 1)[starts]))


_LENGTH, _PIECE = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1B54A32D192ED03)


def word_hashes(buffer: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of every span of bytes, by pieces of eight."""
    padded = buffer + bytes(8)
    pieces = np.ndarray((len(buffer) + 1,), dtype="<u8", buffer=padded, strides=(1,))
    left = (ends - starts).astype(np.int64)
    hashes = mix(left.astype(np.uint64) * _LENGTH)
    on, place = np.arange(len(left)), np.asarray(starts, dtype=np.int64)
    for _ in range(PIECES):
        if not len(on):
            break
        rest = left[on]
        mask = np.full(len(on), (1 << 64) - 1, dtype=np.uint64)
        short = rest < 8
        mask[short] = (np.uint64(1) << (rest[short] * 8).astype(np.uint64)) - np.uint64(1)
        hashes[on] = mix((hashes[on] ^ (pieces[place] & mask)) + _PIECE)
        left[on] = rest - 8
        further = rest > 8
        on, place = on[further], place[further] + 8
    for i, begin in zip(on.tolist(), place.tolist(), strict=True):
        hashes[i] ^= np.uint64(xxhash.xxh3_64_intdigest(buffer[begin : ends[i]]))
    return hashes


def windows(hashes: np.ndarray, n: int, base: int = 0) -> np.ndarray:
    """Hash of n hashes from each one on, as far as there are n to the end."""
    at = np.arange(max(0, len(hashes) - n + 1))
    return span_hashes(hashes, at, at + n, base)


@dataclass
class Words:
    """Words of several texts: byte spans in ``buffer``, and each text's range of words."""

    buffer: bytes
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray  # of text i: words first[i] to first[i + 1]
    hashes: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def word(self, i: int) -> bytes:
        return self.buffer[self.starts[i] : self.ends[i]]

    def windows(self, n: int) -> np.ndarray:
        """Hash of the n words from each word on, as far as there are n words to the end."""
        return windows(self.hashes, n)


def split(texts: list[bytes | None], table: np.ndarray = BY_SPACE, lower: bool = False) -> Words:
    buffer = b"\n".join([t or b"" for t in texts]) + b"\n"
    data = np.frombuffer(buffer, dtype=np.uint8)
    if lower:
        data = _LOWER[data]
        buffer = data.tobytes()
    apart = table[data]
    edges = np.flatnonzero(apart[1:] != apart[:-1]) + 1
    if not apart[0]:
        edges = np.concatenate(([0], edges))
    starts, ends = edges[0::2], edges[1::2]
    sizes = np.fromiter((len(t) + 1 if t else 1 for t in texts), dtype=np.int64, count=len(texts))
    offsets = np.concatenate(([0], np.cumsum(sizes)))
    first = np.searchsorted(starts, offsets)
    return Words(buffer, starts, ends, first, word_hashes(buffer, starts, ends))


