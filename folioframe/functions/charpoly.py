"""Set reconciliation of buckets by characteristic polynomials over the field of 2**61 - 1.

A set of field elements S has the polynomial chi(z) = product of (z - h). The two copies of
a bucket differ in few elements although both may be large, and chi_A / chi_B is then a
rational function of that low degree: it is interpolated from as many evaluations as the
degree bound, verified at further points, and the roots of its numerator and denominator
are the elements only A and only B hold. The bound doubles until the check holds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from . import field61 as G

CHECKS = 2  # further points: a wrong result passes with probability near (degree / 2**61)**2
ONE = np.uint64(1)
CHUNK = 200_000  # rows of whole buckets handled at once


def _evaluate(values: np.ndarray, row: np.ndarray, buckets: int, at: list[int]) -> np.ndarray:
    """chi of each bucket at each point, shape (buckets, points), in whatever order the rows are."""
    out = np.ones((buckets, len(at)), dtype=np.uint64)
    if not len(values):
        return out
    order = np.argsort(row, kind="stable")
    values, row = values[order], row[order]
    z = np.array(at, dtype=np.uint64)
    counts = np.bincount(row, minlength=buckets)
    place = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
    turn = np.argsort(place, kind="stable")  # the i-th elements of all buckets, i after i
    bounds = np.concatenate([[0], np.cumsum(np.bincount(place))])
    for a, b in zip(bounds[:-1], bounds[1:]):
        take = turn[a:b]
        out[row[take]] = G.mul(out[row[take]], G.sub(z[None, :], values[take][:, None]))
    return out


def _powers(at: list[int], count: int) -> np.ndarray:
    return np.array([[pow(z, i, G.P) for i in range(count)] for z in at], dtype=np.uint64).reshape(len(at), count)


def _solve(system: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Gauss-Jordan of many systems at once; unknowns without a pivot become zero."""
    many, size, _ = system.shape
    full = np.concatenate([system, right[:, :, None]], axis=2)
    used = np.zeros((many, size), dtype=bool)
    pivot = np.full((many, size), -1)
    each = np.arange(many)
    for c in range(size):
        free = (full[:, :, c] != 0) & ~used
        has = free.any(axis=1)
        r = free.argmax(axis=1)
        line = G.mul(full[each, r], G.inverse(full[each, r, c])[:, None])
        line = np.where(has[:, None], line, full[each, r])
        factor = np.where(has[:, None], full[:, :, c], np.uint64(0))
        factor[each, r] = 0
        full = G.sub(full, G.mul(factor[:, :, None], line[:, None, :]))
        full[each, r] = line
        used[each, r] |= has
        pivot[has, c] = r[has]
    out = np.zeros((many, size), dtype=np.uint64)
    for c in range(size):
        ok = pivot[:, c] >= 0
        out[ok, c] = full[ok, pivot[ok, c], size]
    return out


def _interpolate(ratio: np.ndarray, at: list[int], above: int, below: int) -> tuple[np.ndarray, np.ndarray]:
    """Monic numerators of degree `above` and denominators of degree `below` through ratio."""
    many, size = len(ratio), above + below
    tops = np.broadcast_to(_powers(at, above + 1)[None], (many, size, above + 1))
    bottoms = G.mul(ratio[:, :, None], _powers(at, below + 1)[None])
    zero = np.zeros(1, dtype=np.uint64)
    system = np.concatenate([tops[:, :, :above], G.sub(zero, bottoms[:, :, :below])], axis=2)
    answer = _solve(system, G.sub(bottoms[:, :, below], tops[:, :, above]))
    ones = np.ones((many, 1), dtype=np.uint64)
    return np.concatenate([answer[:, :above], ones], axis=1), np.concatenate([answer[:, above:], ones], axis=1)


def _horner(poly: np.ndarray, at: list[int]) -> np.ndarray:
    z = np.array(at, dtype=np.uint64)[None, :]
    out = np.zeros((len(poly), len(at)), dtype=np.uint64)
    for i in range(poly.shape[1] - 1, -1, -1):
        out = G._fold(G.mul(out, z) + poly[:, i][:, None])
    return out


def _split(num: np.ndarray, den: np.ndarray) -> tuple[list[int], list[int]] | None:
    """Roots of numerator and denominator without their common factor; None if either has others."""
    p, q = [int(x) for x in num], [int(x) for x in den]
    common = G.poly_gcd(p, q) if len(p) > 1 and len(q) > 1 else [1]
    if len(common) > 1:
        p, q = G.poly_divmod(p, common)[0], G.poly_divmod(q, common)[0]
    above, below = G.roots(p), G.roots(q)
    return None if above is None or below is None else (above, below)


def differing(bucket: np.ndarray, side: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Elements only one side holds as (bucket, side, value); rows are sorted by bucket and
    hold each (bucket, side, value) once. side is 0 or 1."""
    names, row = np.unique(bucket, return_inverse=True)
    found: list[tuple[int, int, int]] = []
    split = [(value[side == s], row[side == s]) for s in (0, 1)]
    sizes = [np.bincount(r, minlength=len(names)) for _, r in split]
    delta = sizes[0] - sizes[1]
    bound = np.abs(delta).astype(np.int64)  # at least so many elements differ
    left, attempt = np.arange(len(names)), 0
    while len(left):
        again = []
        for degree in np.unique(bound[left]):
            group = left[bound[left] == degree]
            index = np.full(len(names), -1)
            index[group] = np.arange(len(group))
            at = G.points(int(degree) + CHECKS, attempt)
            chi = []
            for v, r in split:
                keep = index[r] >= 0
                chi.append(_evaluate(v[keep], index[r[keep]], len(group), at))
            ratio = G.mul(chi[0], G.inverse(chi[1]))
            for d in np.unique(delta[group]):
                same = delta[group] == d
                these, top, low = group[same], (int(degree) + int(d)) // 2, (int(degree) - int(d)) // 2
                num, den = _interpolate(ratio[same][:, :degree], at[:degree], top, low)
                check = at[degree:]
                holds = (G.mul(_horner(num, check), chi[1][same][:, degree:]) == G.mul(_horner(den, check), chi[0][same][:, degree:])).all(axis=1)
                holds &= (chi[0][same] != 0).all(axis=1) & (chi[1][same] != 0).all(axis=1)
                for b, p, q, fine in zip(these, num, den, holds):
                    parts = _split(p, q) if fine else None
                    if parts is None:
                        again.append(b)
                    else:
                        found += [(b, s, x) for s in (0, 1) for x in parts[s]]
        left = np.sort(np.array(again, dtype=np.int64))
        if len(left):
            # A bound of both sizes together always has a solution, so this never ends unsolved.
            if (bound[left] > 4 * (sizes[0] + sizes[1])[left] + 8).any():
                raise ArithmeticError("a bucket has no verified solution although the bound exceeds its size")
            # doubled, in step with the parity of the size difference
            bound[left] = 2 * np.maximum(bound[left], 1) + (2 * np.maximum(bound[left], 1) - delta[left]) % 2
            attempt += 1
    if not found:
        return np.array([], dtype=names.dtype), np.array([], dtype=np.int8), np.array([], dtype=np.uint64)
    b, s, x = zip(*found)
    return names[np.array(b)], np.array(s, dtype=np.int8), np.array(x, dtype=np.uint64)


def recover(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrow form for a partition sorted by _bucket: (_bucket, _side, _h) to the differing
    ones. Whole buckets are taken as they complete, so memory stays near CHUNK rows."""

    def solved(parts: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        b, s, h = (np.concatenate(x) for x in zip(*parts))
        b, s, x = differing(b, s, h.astype(np.uint64))
        return pa.RecordBatch.from_arrays(
            [pa.array(b, pa.int64()), pa.array(s, pa.int8()), pa.array(x.astype(np.int64), pa.int64())], ["_bucket", "_side", "_h"]
        )

    held: list[tuple[np.ndarray, ...]] = []
    rows = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(tuple(batch.column(n).to_numpy(zero_copy_only=False) for n in ("_bucket", "_side", "_h")))
        rows += batch.num_rows
        if rows < CHUNK:
            continue
        b, s, h = (np.concatenate(x) for x in zip(*held))
        last = int(np.searchsorted(b, b[-1]))
        if last:
            yield solved([(b[:last], s[:last], h[:last])])
        held = [(b[last:], s[last:], h[last:])]
        rows = len(b) - last
    if held:
        yield solved(held)


BOUND = 6  # elements that may differ in a bucket if its sketch is to be enough
POINTS = G.points(BOUND + 1 + CHECKS, 0)
HELD = 4_000_000  # buckets times sides whose products a task holds before it emits them


def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrow form for any partition of (_bucket, _side, _h): for each bucket and side in it the
    number of elements and the product of (z - h) at each of POINTS, little-endian."""
    keys: list[np.ndarray] = []
    values: list[np.ndarray] = []
    rows = 0

    def emitted() -> pa.RecordBatch:
        names, row, counts = np.unique(np.concatenate(keys), return_inverse=True, return_counts=True)
        chi = _evaluate(np.concatenate(values), row, len(names), POINTS)
        flat = pa.Array.from_buffers(pa.binary(8 * len(POINTS)), len(names), [None, pa.py_buffer(np.ascontiguousarray(chi))])
        return pa.RecordBatch.from_arrays(
            [pa.array(names >> 1), pa.array((names & 1).astype(np.int8)), pa.array(counts.astype(np.int64)), flat.cast(pa.binary())], ["_bucket", "_side", "_n", "_chi"]
        )

    for batch in batches:
        b, s, h = (batch.column(n).to_numpy(zero_copy_only=False) for n in ("_bucket", "_side", "_h"))
        keys.append(b * 2 + s)
        values.append(h.astype(np.uint64))
        rows += len(b)
        if rows >= HELD:
            yield emitted()
            keys, values, rows = [], [], 0
    if rows:
        yield emitted()


def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrow form for a partition sorted by _bucket that holds its whole sketches: the differing
    (_bucket, _side, _h), and _side -1 for a bucket that differs in more than BOUND elements."""

    def solved(b: np.ndarray, s: np.ndarray, n: np.ndarray, chi: np.ndarray) -> pa.RecordBatch:
        names, row = np.unique(b, return_inverse=True)
        sums = np.zeros((2, len(names)), dtype=np.int64)
        product = np.ones((2, len(names), len(POINTS)), dtype=np.uint64)
        for side in (0, 1):
            mine = s == side
            np.add.at(sums[side], row[mine], n[mine])
            part, place = chi[mine], row[mine]
            counts = np.bincount(place, minlength=len(names))
            nth = np.arange(len(place)) - np.repeat(np.cumsum(counts) - counts, counts)
            for k in range(int(nth.max()) + 1 if len(nth) else 0):
                take = nth == k
                product[side][place[take]] = G.mul(product[side][place[take]], part[take])
        delta = sums[0] - sums[1]
        found: list[tuple[int, int, int]] = []
        for d in np.unique(delta):
            these = np.flatnonzero(delta == d)
            degree = BOUND + (BOUND + int(d)) % 2
            fits = abs(int(d)) <= degree
            same = (product[0][these] == product[1][these]).all(axis=1) & (d == 0)
            if not fits:
                found += [(x, -1, 0) for x in these]
                continue
            these = these[~same]
            if not len(these):
                continue
            a, c = product[0][these], product[1][these]
            ratio = G.mul(a, G.inverse(c))
            num, den = _interpolate(ratio[:, :degree], POINTS[:degree], (degree + int(d)) // 2, (degree - int(d)) // 2)
            check = POINTS[degree:]
            holds = (G.mul(_horner(num, check), c[:, degree:]) == G.mul(_horner(den, check), a[:, degree:])).all(axis=1)
            holds &= (a != 0).all(axis=1) & (c != 0).all(axis=1)
            for x, p, q, fine in zip(these, num, den, holds):
                parts = _split(p, q) if fine else None
                found += [(x, -1, 0)] if parts is None else [(x, side, y) for side in (0, 1) for y in parts[side]]
        x, s, y = zip(*found) if found else ((), (), ())
        return pa.RecordBatch.from_arrays(
            [pa.array(names[np.array(x, dtype=np.int64)], pa.int64()), pa.array(s, pa.int8()), pa.array(y, pa.int64())], ["_bucket", "_side", "_h"]
        )

    held: list[tuple[np.ndarray, ...]] = []
    rows = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        chi = np.frombuffer(b"".join(batch.column(3).to_pylist()), dtype=np.uint64).reshape(-1, len(POINTS))
        held.append((*(batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1, 2)), chi))
        rows += batch.num_rows
        if rows < CHUNK:
            continue
        parts = [np.concatenate(x) for x in zip(*held)]
        last = int(np.searchsorted(parts[0], parts[0][-1]))
        if last:
            yield solved(*(x[:last] for x in parts))
        held = [tuple(x[last:] for x in parts)]
        rows = len(parts[0]) - last
    if held:
        yield solved(*(np.concatenate(x) for x in zip(*held)))
