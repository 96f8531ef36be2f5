"""Set reconciliation by characteristic polynomials against plain set differences."""

import random

import numpy as np
import pyarrow as pa
import pytest

from folioframe.functions import charpoly as C


def elements(seed, buckets):
    rng = random.Random(seed)
    rows, want = [], set()
    for b in range(buckets):
        both = {rng.randrange(1, 2**61 - 1) for _ in range(rng.randrange(30))}
        only = [{rng.randrange(1, 2**61 - 1) for _ in range(rng.choice([0, 0, 1, 2, 3, 9, 25]))} for _ in (0, 1)]
        for s in (0, 1):
            rows += [(b, s, h) for h in sorted(both | only[s])]
            want |= {(b, s, h) for h in only[s]}
    return rows, want


def batch(rows, kinds=(pa.int64(), pa.int8(), pa.int64())):
    return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), kinds)], ["_bucket", "_side", "_h"])


@pytest.mark.parametrize("seed", range(3))
def test_many_buckets_of_mixed_sizes_at_once(seed):
    rows, want = elements(seed, 450)
    b, s, h = (np.array(x) for x in zip(*rows))
    assert set(zip(*(x.tolist() for x in C.differing(b, s, h.astype(np.uint64))))) == want


@pytest.mark.parametrize("parts", [1, 3, 20])
def test_sketches_of_any_parts(parts):
    rows, want = elements(7, 120)
    random.Random(parts).shuffle(rows)
    sketches = pa.Table.from_batches([x for k in range(parts) for x in C.sketch(iter([batch(rows[k::parts])]))])
    [whole] = sketches.sort_by("_bucket").combine_chunks().to_batches()
    got = {tuple(r.values()) for out in C.solve(iter([whole])) for r in out.to_pylist()}
    beyond = {b for b, s, _ in got if s == -1}
    assert {x for x in got if x[1] >= 0} == {x for x in want if x[0] not in beyond}
    assert all(sum(x[0] == b for x in want) > C.BOUND for b in beyond)
    rest = sorted(r for r in rows if r[0] in beyond)
    again = {tuple(r.values()) for out in C.recover(iter([batch(rest)])) for r in out.to_pylist()}
    assert again == {x for x in want if x[0] in beyond}
