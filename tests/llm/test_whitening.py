import math
import random

import numpy as np
import pytest

from tests.llm.cases import SPLIT_EARLY, settings
from wardline.llm.whitening import whiten_embeddings

SCHEMA = "vec_id long, embedding array<double>, label int, x string, n string, weight string, component string, size string"


def frame(spark, data):
    return spark.createDataFrame([(i, v, 0, "x", "x", "x", "x", "x") for i, v in data], SCHEMA)


def usable(data):
    return [
        (i, tuple(math.floor(256 * c) for c in v)) for i, v in data
        if v and all(c is not None and math.isfinite(c) for c in v)
    ]


def expected(data, weights="one", components=4):
    """(vec_id, component) -> n, deviation, |whitened|, explained, by length."""
    out = []
    rows = usable(data)
    for size in {len(x) for _, x in rows}:
        own = [(i, x) for i, x in rows if len(x) == size]
        distinct = sorted({x for _, x in own})
        copies = [sum(x == y for _, y in own) if weights == "copies" else 1 for x in distinct]
        n, sums = sum(copies), [sum(w * x[d] for w, x in zip(copies, distinct)) for d in range(size)]
        moved = np.array([[(n * c - s) / n for c, s in zip(x, sums)] for x in distinct])
        cov = (moved * np.array(copies)[:, None]).T @ moved / n
        values, vectors = np.linalg.eigh(cov)
        values, vectors = values[::-1], vectors[:, ::-1]
        for i, x in own:
            dev = sum((n * c - s) ** 2 for c, s in zip(x, sums))
            for k in range(min(components, size)):
                has = values[k] > 1e-13 * np.trace(cov)
                z = abs((np.array([(n * c - s) / n for c, s in zip(x, sums)]) @ vectors[:, k]) / math.sqrt(values[k])) if has else None
                out.append((i, k + 1, n, dev if dev < 2**63 else None, z, max(values[k], 0) / np.trace(cov) if np.trace(cov) > 0 else None))
    return sorted(out, key=lambda r: (str(r[0]), r[1], r[2], str(r[3]), str(r[4])))


def vectors(n, width, seed):
    draw = random.Random(seed)
    return [(i, [draw.gauss(0, 1 + d) for d in range(width)]) for i in range(n)]


CASES = {
    "plain": vectors(300, 8, 1),
    "repeated": [*vectors(60, 5, 2), *[(1000 + i, vectors(60, 5, 2)[7][1]) for i in range(100)], *vectors(60, 5, 2)],
    "broken": [*vectors(30, 4, 3), (None, [1.0, 2.0, 3.0, 4.0]), (50, None), (51, [1.0, None, 2.0, 3.0]), (52, [math.nan] * 4), (53, [math.inf] * 4), (54, [])],
    "lengths": [*vectors(30, 3, 4), *[(100 + i, v) for i, v in vectors(20, 2, 5)], (200, [1.0])],
    "one row": [(3, [0.5, 0.25])],
    "flat": [(i, [float(i), 2.0 * i, 1.0]) for i in range(20)],
    "large": [(i, [1e6 * c for c in v]) for i, v in vectors(50, 4, 6)],
    "negative zero": [*vectors(10, 2, 7), (20, [-0.0, 0.0]), (21, [0.0, -0.0])],
}


@pytest.mark.parametrize("name", CASES)
@pytest.mark.parametrize("weights", ["one", "copies"])
def test_answers(spark, name, weights):
    got = whiten_embeddings(frame(spark, CASES[name]), weights=weights).collect()
    found = [(r["vec_id"], r["component"], r["n"], r["deviation"], None if r["whitened"] is None else abs(r["whitened"]), r["explained"]) for r in got]
    wanted = expected(CASES[name], weights)
    assert len(found) == len(wanted)
    for a, b in zip(sorted(found, key=lambda r: (str(r[0]), r[1], r[2], str(r[3]), str(r[4]))), wanted):
        assert a[:4] == b[:4]
        assert (a[4] is None) == (b[4] is None) and (a[5] is None) == (b[5] is None)
        assert a[4] is None or a[4] == pytest.approx(b[4], rel=1e-8, abs=1e-8)
        assert a[5] is None or a[5] == pytest.approx(b[5], rel=1e-6, abs=1e-12)
    assert all(r["identity_error"] <= 1e-8 for r in got)


def test_signs_agree_and_rows_are_uncorrelated(spark):
    got = whiten_embeddings(frame(spark, CASES["plain"])).collect()
    z = np.zeros((300, 4))
    for r in got:
        z[r["vec_id"], r["component"] - 1] = r["whitened"]
    assert np.abs(np.cov(z.T, bias=True) - np.eye(4)).max() < 1e-9


def test_values_beyond_64_bits(spark):
    got = whiten_embeddings(frame(spark, [(1, [1e30, 0.0]), (2, [-1e30, 1.0]), (3, [2.0, 3.0])])).collect()
    assert len(got) == 6 and {r["vec_id"] for r in got if r["deviation"] is None} == {1, 2}


def test_empty_table(spark):
    assert whiten_embeddings(frame(spark, [])).collect() == []
    assert whiten_embeddings(frame(spark, [(1, None), (2, [])])).collect() == []


def test_a_hot_vector_is_split_in_the_join(spark):
    hot = vectors(1, 8, 8)[0][1]
    data = [*vectors(2000, 8, 9), *[(10_000 + i, hot) for i in range(4000)]]
    with settings(spark, SPLIT_EARLY):
        df = whiten_embeddings(frame(spark, data).repartition(8))
        df.collect()
        assert "skew=true" in df._jdf.queryExecution().executedPlan().toString()
