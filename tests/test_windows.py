import random
import statistics

import pytest
from helpers import days, rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from candlewick.operators.windows import (
    autocorrelation,
    group_rank,
    latest_per,
    number_rows,
    rolling,
    rolling_corr,
)


def pearson(x, y):
    try:
        return statistics.correlation(x, y)
    except statistics.StatisticsError:
        return None


def test_rolling_emits_partial_frames(table):
    df = table("s string, day date, v double", *[("a", x, float(i)) for i, x in enumerate(days("2024-01-01", 10))])
    out = rolling(df, by="s", order="day", frames={"m": ("avg", "v", 7), "n": ("count", None, 7), "sd": ("stddev", "v", 7)})
    got = {r.v: r for r in out.collect()}
    assert got[0.0].m == 0.0 and got[0.0].sd is None and got[0.0].n == 1
    assert got[9.0].m == 6.0 and got[9.0].n == 7


def test_full_window_mean_is_null_until_complete(table):
    df = table("s string, day date, v double", *[("a", x, 1.0) for x in days("2024-01-01", 8)])
    out = rolling(df, by="s", order="day", frames={"m": ("avg", "v", 7)}, full_window=True)
    assert [r.m for r in out.orderBy("day").collect()] == [None] * 6 + [1.0, 1.0]


def test_rolling_corr_matches_brute_force(table):
    rng = random.Random(7)
    x = [round(rng.gauss(0, 3), 4) for _ in range(120)]
    y = [round(0.5 * a + rng.gauss(0, 2), 4) for a in x]
    x[40:75] = [1.5] * 35  # a constant stretch longer than the short frame
    df = table("s string, day date, x double, y double", *[("a", t, a, b) for t, a, b in zip(days("2024-01-01", 120), x, y)])
    out = rolling_corr(
        df, by=["s"], order="day", x="x", y="y", rows={"c30": 30, "c90": 90}, counts={"n30": 30, "n90": 90}
    )
    for i, r in enumerate(out.orderBy("day").collect()):
        for n, c, count in ((30, r.c30, r.n30), (90, r.c90, r.n90)):
            lo = max(0, i - n + 1)
            want = pearson(x[lo : i + 1], y[lo : i + 1])
            assert count == i + 1 - lo
            assert (c is None) == (want is None), (i, n, c, want)
            if c is not None:
                assert c == pytest.approx(want, abs=1e-9) and abs(c) <= 1 + 1e-9


def test_constant_returns_have_no_correlation(table):
    df = table("s string, day date, x double, y double", *[("a", t, 1.0, float(i)) for i, t in enumerate(days("2024-01-01", 4))])
    out = rolling_corr(df, by=["s"], order="day", x="x", y="y", rows={"c": 30})
    assert [r.c for r in out.collect()] == [None] * 4


def test_rank_with_null_and_ties(table):
    df = table("d int, s string, v double", (1, "a", None), (1, "b", 3.0), (1, "c", 3.0), (1, "e", -1.0), (2, "a", 0.0))
    out = group_rank(df, by="d", value="v", high="up", low="down")
    assert rows(out, "d", "s", "up", "down") == [
        (1, "a", 1, 4), (1, "b", 2, 2), (1, "c", 2, 2), (1, "e", 4, 1), (2, "a", 1, 1)
    ]


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 1), st.one_of(st.none(), st.integers(-3, 3))), min_size=1, max_size=25))
def test_rank_equals_counting(table, values):
    data = [(g, f"s{i}", None if v is None else float(v)) for i, (g, v) in enumerate(values)]
    out = group_rank(table("g int, s string, v double", *data), by="g", value="v", high="up", low="down")
    for r in out.collect():
        peers = [v for g, _, v in data if g == r.g]
        up = [v for v in peers if (v is None and r.v is not None) or (v is not None and r.v is not None and v > r.v)]
        down = [v for v in peers if v is not None and (r.v is None or v < r.v)]
        assert (r.up, r.down) == (1 + len(up), 1 + len(down))


def test_latest_row_per_key(table):
    df = table("s string, day date, v int", *[(s, x, i) for s in "ab" for i, x in enumerate(days("2024-01-01", 5))])
    assert rows(latest_per(df, by="s", order="day"), "s", "v") == [("a", 4), ("b", 4)]


def test_number_rows_counts_in_order_over_partitions(spark):
    df = spark.range(1000).selectExpr("cast(id * 7919 % 1000 as string) as k")
    out = number_rows(df, order_by=["k"], name="n", start=5).orderBy("n").collect()
    assert [r.n for r in out] == list(range(5, 1005))
    assert [r.k for r in out] == sorted(r.k for r in out)


def test_autocorrelation_matches_brute_force(table):
    rng = random.Random(3)
    x = [round(rng.gauss(0, 1), 4) for _ in range(60)]
    df = table("s string, day date, x double", *[("a", t, v) for t, v in zip(days("2024-01-01", 60), x)],
               *[("flat", t, 2.0) for t in days("2024-01-01", 10)])
    got = {(r.s, r.lag): r for r in autocorrelation(df, by="s", order="day", col="x", lags=[1, 5]).collect()}
    for k in (1, 5):
        assert got["a", k].autocorrelation == pytest.approx(pearson(x[k:], x[:-k]))
        sizes = [abs(v) for v in x]
        assert got["a", k].abs_autocorrelation == pytest.approx(pearson(sizes[k:], sizes[:-k]))
        assert got["a", k].observations == 60 - k
        assert got["flat", k].autocorrelation is None


def test_a_huge_return_does_not_stop_the_correlation(table):
    rng = random.Random(5)
    x = [round(rng.gauss(0, 1), 4) for _ in range(60)]
    y = [round(a + rng.gauss(0, 1), 4) for a in x]
    x[10] = 79999999900.0  # from a hundred-millionth to eight
    df = table("s string, day date, x double, y double", *[("a", t, a, b) for t, a, b in zip(days("2024-01-01", 60), x, y)])
    got = rolling_corr(df, by=["s"], order="day", x="x", y="y", rows={"c": 30}).orderBy("day").collect()
    for i in (30, 39, 45, 59):
        assert got[i].c == pytest.approx(pearson(x[max(0, i - 29) : i + 1], y[max(0, i - 29) : i + 1]), abs=1e-6)


@pytest.mark.parametrize("size", [2e5, 1e17, 1e300])
def test_any_finite_return_has_a_correlation(table, size):
    rng = random.Random(6)
    x = [round(rng.gauss(0, 1), 4) for _ in range(50)]
    y = [round(a + rng.gauss(0, 1), 4) for a in x]
    x[20], y[20] = size, -size
    df = table("s string, day date, x double, y double", *[("a", t, a, b) for t, a, b in zip(days("2024-01-01", 50), x, y)])
    got = rolling_corr(df, by=["s"], order="day", x="x", y="y", rows={"c": 10}).orderBy("day").collect()
    for i in (15, 19, 30, 49):
        assert got[i].c == pytest.approx(pearson(x[max(0, i - 9) : i + 1], y[max(0, i - 9) : i + 1]), abs=1e-9)
    assert all(got[i].c == pytest.approx(-1.0, abs=1e-6) for i in range(21, 29))


def test_limbs_are_exact_at_their_limit(table):
    """Sums of products far beyond 64 bits, of values that differ in the last digit."""
    from fractions import Fraction

    base = 214748.0
    x = [base + i % 3 / 10000 for i in range(200)]
    y = [-base + i % 5 / 10000 for i in range(200)]
    df = table("s string, day date, x double, y double", *[("a", t, a, b) for t, a, b in zip(days("2024-01-01", 200), x, y)])
    got = rolling_corr(df, by=["s"], order="day", x="x", y="y", rows={"c": 90}, extreme=False).orderBy("day").collect()
    for i in (5, 89, 150, 199):
        a, b = ([round(v * 10000) for v in z[max(0, i - 89) : i + 1]] for z in (x, y))
        n = len(a)
        cov, va, vb = (n * sum(p * q for p, q in zip(u, v)) - sum(u) * sum(v) for u, v in ((a, b), (a, a), (b, b)))
        want = float(Fraction(cov)) / (float(va) ** 0.5 * float(vb) ** 0.5)
        assert got[i].c == pytest.approx(want, abs=1e-12)
