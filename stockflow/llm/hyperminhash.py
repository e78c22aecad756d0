"""HyperMinHash registers: bucketed minima as leading-zero count plus mantissa bits."""

from __future__ import annotations

import numpy as np

from stockflow.llm.arrays import mix

BANDS, ROWS = 32, 5
REGISTERS = BANDS * ROWS
VALUE_BITS, MANTISSA = 40, 10
_PROBES = np.stack([np.random.Generator(np.random.PCG64(1000 + j)).permutation(REGISTERS) for j in range(REGISTERS)])
_U = np.uint64


def registers(hashes: np.ndarray) -> np.ndarray:
    """REGISTERS 16-bit registers of one non-empty set of 64-bit hashes.

    A bucket keeps its least 40-bit value as the number of leading zeros (6 bits) and the 10 bits
    behind the leading one. A bucket that no hash falls into takes the register of the first filled
    bucket on its own fixed probe path, so two sets agree in it about as often as they overlap.
    """
    bucket = ((hashes >> _U(32)) * _U(REGISTERS)) >> _U(32)
    value = mix(hashes ^ _U(0xA0761D6478BD642F)) >> _U(64 - VALUE_BITS)
    key = np.sort(bucket << _U(VALUE_BITS) | value)
    b = (key >> _U(VALUE_BITS)).astype(np.int64)
    first = np.flatnonzero(np.r_[True, b[1:] != b[:-1]])
    low = (key[first] & _U((1 << VALUE_BITS) - 1)).astype(np.int64)
    length = np.frexp(low.astype(np.float64))[1]  # bits of the value; 40 bits are exact in a double
    shift = length - 1 - MANTISSA
    tail = np.where(shift >= 0, low >> np.maximum(shift, 0), low << np.maximum(-shift, 0)) & ((1 << MANTISSA) - 1)
    out = np.zeros(REGISTERS, np.uint16)
    filled = np.zeros(REGISTERS, bool)
    out[b[first]], filled[b[first]] = (VALUE_BITS - length) << MANTISSA | np.where(low > 0, tail, 0), True
    if not filled.all():
        empty = np.flatnonzero(~filled)
        path = _PROBES[empty]
        out[empty] = out[path[np.arange(len(empty)), filled[path].argmax(1)]]
    return out


def band_keys(regs: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band of register rows [n, REGISTERS]."""
    part = regs.reshape(-1, BANDS, ROWS).astype(np.uint64)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), part.shape[:2]).copy()
    for k in range(ROWS):
        key = mix(key * _U(0x9E3779B97F4A7C15) + part[:, :, k])
    return key


def collision_rate(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Chance that the registers of two unrelated sets of n and m hashes agree.

    Minima of a bucket with x hashes of mean n / REGISTERS lie near 1 / (x + 1); two registers with
    the same number of leading zeros agree in the mantissa with chance 2 ** -MANTISSA.
    """
    a, b = np.maximum(n / REGISTERS, 1.0), np.maximum(m / REGISTERS, 1.0)
    k = np.arange(1, VALUE_BITS)[:, None]
    hi, lo = 2.0 ** -(k - 1), 2.0 ** -k
    same = lambda x: (1 - lo) ** x - (1 - hi) ** x  # noqa: E731  chance of k - 1 leading zeros
    return (same(a) * same(b)).sum(0) * 2.0 ** -MANTISSA


def jaccard(left: np.ndarray, right: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Jaccard estimates from register rows, corrected for chance agreements."""
    agree = (left == right).mean(1)
    c = collision_rate(n, m)
    return np.clip((agree - c) / (1 - c), 0, 1)
