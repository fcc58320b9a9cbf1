"""Counting quotient filters without loss: compact counts of keys of a fixed number of bits (helpers for tasks).

A key is permuted within its bits by an invertible mixing, so that any keys spread evenly.  The leading bits of the
permuted key are its quotient, the others its remainder.  A filter lists its entries in ascending order: how many
each quotient has in unary, the remainders in full, and counters of a byte with longer ones behind.  So nothing of a
key is lost, and filters of the same bits merge like sorted lists.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import zstandard

FACTORS = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
# Entries whose remainders are spread to bits at once; a multiple of eight.
AT_ONCE = 1 << 15


def _mask(bits: int) -> np.uint64:
    return np.uint64((1 << bits) - 1)


def permuted(keys: np.ndarray, bits: int) -> np.ndarray:
    """One to one among the numbers of ``bits`` bits (at most 63)."""
    half = np.uint64((bits + 1) // 2)
    x = keys.astype(np.uint64)
    for factor in FACTORS:
        x = ((x ^ (x >> half)) * np.uint64(factor)) & _mask(bits)
    return x ^ (x >> half)


def restored(mixed: np.ndarray, bits: int) -> np.ndarray:
    """The keys that :func:`permuted` made these of."""
    half = np.uint64((bits + 1) // 2)
    x = mixed ^ (mixed >> half)
    for factor in reversed(FACTORS):
        x = (x * np.uint64(pow(factor, -1, 1 << 64))) & _mask(bits)
        x = x ^ (x >> half)
    return x.astype(np.int64)


def _bits_of(values: np.ndarray, width: int) -> bytes:
    """Each value in ``width`` bits, one behind another."""
    if not width:
        return b""
    shifts = np.arange(width - 1, -1, -1, dtype=np.uint64)
    parts = [np.packbits(((values[k:k + AT_ONCE, None] >> shifts) & np.uint64(1)).astype(np.uint8)) for k in range(0, len(values), AT_ONCE)]
    return b"".join(part.tobytes() for part in parts)


def _values_of(packed: np.ndarray, width: int, n: int) -> np.ndarray:
    out = np.zeros(n, np.uint64)
    shifts = np.arange(width - 1, -1, -1, dtype=np.uint64)
    for k in range(0, n if width else 0, AT_ONCE):
        rows = min(AT_ONCE, n - k)
        bits = np.unpackbits(packed[k * width // 8:(k * width + rows * width + 7) // 8])[:rows * width].reshape(rows, width)
        out[k:k + rows] = (bits.astype(np.uint64) << shifts).sum(axis=1)
    return out


@dataclass(frozen=True)
class Filter:
    """Ascending permuted keys of ``bits`` bits without their first ``lead`` bits, which all share, and their counts."""

    bits: int
    lead: int
    mixed: np.ndarray
    counts: np.ndarray

    @classmethod
    def of(cls, keys: np.ndarray, bits: int) -> "Filter":
        mixed, counts = np.unique(permuted(keys, bits), return_counts=True)
        return cls(bits, 0, mixed, counts.astype(np.int64))

    @classmethod
    def merged(cls, filters: list["Filter"]) -> "Filter":
        """One filter of filters with the same bits and leading bits."""
        mixed = np.concatenate([f.mixed for f in filters])
        order = np.argsort(mixed, kind="stable")  # takes the ascending runs together
        mixed, counts = mixed[order], np.concatenate([f.counts for f in filters])[order]
        starts = np.flatnonzero(np.concatenate([[True], mixed[1:] != mixed[:-1]])) if len(mixed) else np.zeros(0, np.int64)
        return cls(filters[0].bits, filters[0].lead, mixed[starts], np.add.reduceat(counts, starts) if len(starts) else counts)

    def split(self, more: int) -> list[tuple[int, "Filter"]]:
        """Parts by the next ``more`` bits, with these bits' number; empty parts are left out."""
        rest = self.bits - self.lead - more
        number = (self.mixed >> np.uint64(rest)).astype(np.int64)
        starts = np.flatnonzero(np.concatenate([[True], number[1:] != number[:-1]])) if len(number) else []
        ends = [*starts[1:], len(number)]
        return [(int(number[a]), Filter(self.bits, self.lead + more, self.mixed[a:b] & _mask(rest), self.counts[a:b])) for a, b in zip(starts, ends)]

    def keys(self, lead_bits: int = 0) -> np.ndarray:
        """The keys as they came, given the number that the leading bits make."""
        whole = self.mixed | (np.uint64(lead_bits) << np.uint64(self.bits - self.lead))
        return restored(whole, self.bits)

    def pack(self) -> bytes:
        n, width = len(self.mixed), self.bits - self.lead
        quotient_bits = min(width, max(n, 1).bit_length() - 1)
        rest = width - quotient_bits
        ends = np.arange(n) + (self.mixed >> np.uint64(rest)).astype(np.int64)  # a one for each entry, a zero behind each quotient
        unary = np.zeros(n + (1 << quotient_bits), np.uint8)
        unary[ends] = 1
        small = np.minimum(self.counts, 255).astype(np.uint8)
        counters = zstandard.compress(small.tobytes() + self.counts[small == 255].astype("<i8").tobytes(), 1)
        head = np.array([self.bits, self.lead, n, quotient_bits, len(counters)], "<i8").tobytes()
        return head + counters + np.packbits(unary).tobytes() + _bits_of(self.mixed & _mask(rest), rest)

    @classmethod
    def unpack(cls, data: bytes) -> "Filter":
        bits, lead, n, quotient_bits, length = np.frombuffer(data, "<i8", 5).tolist()
        at = 40 + length
        counters = np.frombuffer(zstandard.decompress(data[40:at]), np.uint8)
        counts = counters[:n].astype(np.int64)
        counts[counts == 255] = np.frombuffer(counters[n:].tobytes(), "<i8")
        size = n + (1 << quotient_bits)
        ones = np.flatnonzero(np.unpackbits(np.frombuffer(data, np.uint8, (size + 7) // 8, at))[:size])
        rest = bits - lead - quotient_bits
        remainders = _values_of(np.frombuffer(data, np.uint8, -1, at + (size + 7) // 8), rest, n)
        quotients = (ones - np.arange(n)).astype(np.uint64)
        return cls(bits, lead, (quotients << np.uint64(rest)) | remainders, counts)
