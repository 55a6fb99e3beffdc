import math
import random

import pytest

from candlewick.llm import topk as K


def brute(queries, rows, k):
    good = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    asked = [(i, [math.floor(256 * x) for x in v]) for i, v in queries if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, a in asked:
        scores = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in good if i != q and len(a) == len(b))
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores[:k])]
    return sorted(out)


@pytest.mark.parametrize("bins", [4, 1024])
def test_against_brute_force(spark, bins):
    rnd = random.Random(bins)
    rows = [(i, [rnd.choice([-1.0, 0.0, 0.25, 0.5, rnd.random()]) for _ in range(6)]) for i in range(300)]
    rows += [(300 + i, [0.5] * 6) for i in range(120)]  # ties for everyone
    rows += [(1000, None), (1001, []), (1002, [None] * 6), (1003, [float("nan")] * 6), (1004, [float("inf")] * 6), (1005, [1.0] * 3), (1006, [2.0] * 3), (None, [1.0] * 6)]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "id long, vector array<float>, q string").repartition(4)
    asked = [x for x in rows if x[0] is not None and x[0] % 7 == 0 or x[0] in (1000, 1003, 1005)]
    queries = spark.createDataFrame(asked, "id long, vector array<float>")
    import struct

    exact = lambda rs: [(i, None if v is None else [None if x is None else struct.unpack("f", struct.pack("f", x))[0] for x in v]) for i, v in rs]
    got = K.exact_top_k(queries, df, 5, bins=bins, query_block=16, candidate_block=50).collect()
    assert sorted(map(tuple, got)) == brute(exact(asked), exact(rows), 5)


def test_fewer_candidates_than_k(spark):
    df = spark.createDataFrame([(1, [1.0]), (2, [2.0]), (3, [3.0])], "id long, vector array<double>")
    got = K.exact_top_k(df.where("id = 2"), df, 5).collect()
    assert sorted(map(tuple, got)) == [(2, 1, 3, 512 * 768), (2, 2, 1, 512 * 256)]


def test_empty_tables(spark):
    df = spark.createDataFrame([(1, [1.0])], "id long, vector array<double>")
    assert K.exact_top_k(df.where("id = 5"), df, 5).collect() == []
    assert K.exact_top_k(df, df, 5).collect() == []
    assert K.exact_top_k(df, df.where("id = 5"), 5).collect() == []


def test_repeated_rows(spark):
    df = spark.createDataFrame([(1, [1.0]), (1, [1.0]), (2, [1.0]), (2, [1.0])], "id long, vector array<double>")
    got = K.exact_top_k(df.where("id = 1"), df, 5).collect()
    assert sorted(map(tuple, got)) == [(1, 1, 2, 65536), (1, 1, 2, 65536), (1, 2, 2, 65536), (1, 2, 2, 65536)]
