"""Arithmetic in the prime field of 2**61 - 1: numpy for many elements, ints for small polynomials."""

from __future__ import annotations

import numpy as np

P = (1 << 61) - 1
_P = np.uint64(P)
_LOW = np.uint64((1 << 32) - 1)
_LOW29 = np.uint64((1 << 29) - 1)
_S32, _S29, _S61, _S3 = np.uint64(32), np.uint64(29), np.uint64(61), np.uint64(3)


def _fold(x: np.ndarray) -> np.ndarray:
    x = (x & _P) + (x >> _S61)
    return np.where(x >= _P, x - _P, x)


def mul(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a * b mod p for elements below p, element by element, with broadcasting."""
    a1, a0, b1, b0 = a >> _S32, a & _LOW, b >> _S32, b & _LOW
    middle = a1 * b0 + a0 * b1  # below 2**62
    low = a0 * b0  # below 2**64
    # a1*b1*2**64 = a1*b1*8; middle*2**32 is split where 2**61 falls
    total = ((a1 * b1) << _S3) + (middle >> _S29) + ((middle & _LOW29) << _S32) + (low & _P) + (low >> _S61)
    return _fold(_fold(total))


def sub(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.where(a >= b, a - b, a + (_P - b))


def inverse(a: np.ndarray) -> np.ndarray:
    """a**(p-2); zero gives zero."""
    result, base, left = np.ones_like(a), a, P - 2
    while left:
        if left & 1:
            result = mul(result, base)
        base, left = mul(base, base), left >> 1
    return result


def points(count: int, attempt: int) -> list[int]:
    """Evaluation points, the same everywhere, different for each attempt."""
    out, state = [], (attempt + 1) * 0x9E3779B97F4A7C15
    for _ in range(count):
        state = (state + 0x9E3779B97F4A7C15) & (2**64 - 1)
        z = ((state ^ (state >> 30)) * 0xBF58476D1CE4E5B9) & (2**64 - 1)
        z = ((z ^ (z >> 27)) * 0x94D049BB133111EB) & (2**64 - 1)
        out.append((z ^ (z >> 31)) % P)
    return out


# Polynomials of Python ints, lowest coefficient first, without leading zeros.


def trim(a: list[int]) -> list[int]:
    while a and not a[-1]:
        a.pop()
    return a


def monic(a: list[int]) -> list[int]:
    if not a or a[-1] == 1:
        return a
    over = pow(a[-1], P - 2, P)
    return [x * over % P for x in a]


def poly_divmod(a: list[int], b: list[int]) -> tuple[list[int], list[int]]:
    """Quotient and remainder by a monic b."""
    rest, out = a[:], [0] * max(0, len(a) - len(b) + 1)
    for i in range(len(a) - len(b), -1, -1):
        c = rest[i + len(b) - 1]
        out[i] = c
        if c:
            for j, x in enumerate(b):
                rest[i + j] = (rest[i + j] - c * x) % P
    return trim(out), trim(rest[: len(b) - 1])


def poly_gcd(a: list[int], b: list[int]) -> list[int]:
    a, b = monic(trim(a[:])), monic(trim(b[:]))
    while b:
        a, b = b, monic(poly_divmod(a, b)[1])
    return a


def _mul_mod(a: list[int], b: list[int], f: list[int]) -> list[int]:
    if not a or not b:
        return []
    out = [0] * (len(a) + len(b) - 1)
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            out[i + j] += x * y
    return poly_divmod(trim([x % P for x in out]), f)[1]


def _half_power(shift: int, f: list[int]) -> list[int]:
    """(x + shift)**((p-1)/2) mod f; the exponent is 2**60 - 1, built by doubling runs of ones."""
    ones = {1: poly_divmod([shift, 1], f)[1]}
    for whole, part in ((2, 1), (3, 2), (6, 3), (12, 6), (15, 12), (30, 15), (60, 30)):
        y = ones[part]
        for _ in range(whole - part):
            y = _mul_mod(y, y, f)
        ones[whole] = _mul_mod(y, ones[whole - part], f)
    return ones[60]


def roots(f: list[int]) -> list[int] | None:
    """The roots of a monic polynomial that splits into distinct linear factors; else None."""
    done: list[int] = []
    todo, shift, limit = [f], 1, 64 + 8 * len(f)
    while todo:
        g = todo.pop()
        if len(g) == 1:
            continue
        if len(g) == 2:
            done.append((-g[0]) % P)
            continue
        if shift > limit:
            return None
        s = _half_power(shift, g)
        shift += 1
        h = poly_gcd(g, trim([(c - (1 if i == 0 else 0)) % P for i, c in enumerate(s or [0])]))
        if 1 < len(h) < len(g):
            todo += [h, poly_divmod(g, h)[0]]
        else:
            todo.append(g)
    return done if len(set(done)) == len(f) - 1 else None
