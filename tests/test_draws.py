"""Seeded draws: parity with an independent SQL engine and distribution checks (5 sigma)."""

import math

import duckdb
import pytest

from clinicgen.config import Config
from clinicgen.functions import draws as D

N = 20000


def _rows(spark, *exprs):
    return spark.range(N).selectExpr("id", *exprs).orderBy("id").collect()


def test_uniform_matches_duckdb(spark):
    got = [r["u"] for r in _rows(spark, f"{D.u(82, 'lbl', 'id', slot=2)} AS u")]
    sql = ("SELECT ('0x' || substr(sha256('82|lbl|' || CAST(i AS VARCHAR)), 27, 13))::BIGINT / 4503599627370496.0 AS u "
           f"FROM range({N}) t(i) ORDER BY i")
    want = [r[0] for r in duckdb.sql(sql).fetchall()]
    assert got == want
    assert all(0.0 <= x < 1.0 for x in got)


def _within(count, n, p, sigmas=5.0):
    return abs(count - n * p) <= sigmas * math.sqrt(n * p * (1 - p)) + 1


def test_weighted_choice_frequencies(spark):
    cfg = Config()
    rows = _rows(spark, f"{D.weighted_choice(D.u(1, 'w', 'id'), cfg.strata)} AS v")
    total = sum(w for _, w in cfg.strata)
    for v, w in cfg.strata:
        assert _within(sum(1 for r in rows if r["v"] == v), N, w / total), v


def test_weighted_choice_unnormalised_and_bounds(spark):
    expr = D.weighted_choice("CAST(id AS DOUBLE) / 10", [("a", 2.0), (None, 1.0), ("c", 1.0)])
    got = [r["v"] for r in spark.range(10).selectExpr(f"{expr} AS v").orderBy("id").collect()]
    # bounds 0.5, 0.75: u at a bound goes to the next category
    assert got == ["a"] * 5 + [None] * 3 + ["c"] * 2


def test_bernoulli_rate(spark):
    rows = _rows(spark, f"{D.bernoulli(D.u(3, 'b', 'id'), 85)} AS v")
    assert _within(sum(1 for r in rows if r["v"]), N, 0.85)


def test_exp_clipped_mean_and_cap(spark):
    rows = _rows(spark, f"{D.exp_clipped_ms(D.u(4, 'e', 'id'), 45, 180, 60000)} AS v")
    vals = [r["v"] / 60000 for r in rows]
    assert max(vals) <= 180 and min(vals) >= 0
    # mean of min(Exp(45), 180) = 45 * (1 - exp(-4))
    mean = 45 * (1 - math.exp(-4))
    assert abs(sum(vals) / N - mean) < 5 * 45 / math.sqrt(N)
    zero = spark.range(1).selectExpr(f"{D.exp_clipped_ms('0.0D', 45, 180, 60000)} AS v").first()["v"]
    top = spark.range(1).selectExpr(f"{D.exp_clipped_ms('0.9999999999D', 45, 180, 60000)} AS v").first()["v"]
    assert zero == 0 and top == 180 * 60000


def test_trunc_normal_range_and_mean(spark):
    rows = _rows(spark, f"{D.trunc_normal_int(5, 'age', 'id', 45, 15, 23, 70)} AS v")
    vals = [r["v"] for r in rows]
    assert min(vals) >= 23 and max(vals) <= 70
    assert abs(sum(vals) / N - 45.5) < 1.0
    one = spark.range(50).selectExpr(f"{D.trunc_normal_int(5, 'x', 'id', 44.5, 0.3, 44, 44)} AS v").collect()
    assert {r["v"] for r in one} == {44}


def test_trunc_normal_truncates_toward_zero(spark):
    rows = _rows(spark, f"{D.trunc_normal_int(6, 'z', 'id', 0.0, 0.5, 0, 116)} AS v")
    # N(0, 0.5) values in (-1, 1) truncate to 0: about 95% of draws are 0
    assert sum(1 for r in rows if r["v"] == 0) > 0.9 * N


def test_trunc_normal_rare_range(spark):
    """Ages 80..90 under N(45, 15): no redraws, so a rare range costs nothing; frequencies follow the discrete law."""
    vals = [r["v"] for r in _rows(spark, f"{D.trunc_normal_int(7, 'old', 'id', 45, 15, 80, 90)} AS v")]
    assert set(vals) <= set(range(80, 91))
    tail = lambda x: 0.5 * math.erfc((x - 45) / 15 / math.sqrt(2))
    for v in range(80, 91):
        assert _within(vals.count(v), N, (tail(v) - tail(v + 1)) / (tail(80) - tail(91))), v
    with pytest.raises(ValueError, match="no mass"):
        D.trunc_normal_int(7, "far", "id", 0, 1, 50, 60)
    with pytest.raises(ValueError):
        D.trunc_normal_int(7, "far", "id", 0, 1, 5, 4)


def test_draw_int_and_date_bounds(spark):
    lo, hi = "DATE'2024-02-28'", "DATE'2024-03-01'"
    rows = _rows(spark, f"{D.draw_int(D.u(8, 'i', 'id'), 3, 7)} AS i", f"{D.draw_date(D.u(8, 'd', 'id'), lo, hi)} AS d")
    assert {r["i"] for r in rows} == {3, 4, 5, 6, 7}
    assert {str(r["d"]) for r in rows} == {"2024-02-28", "2024-02-29", "2024-03-01"}


def test_draw_two_distinct(spark):
    d1, d2 = D.draw_two_distinct(D.u(9, 'a', 'id'), "0.0D", D.u(9, 'c', 'id'), ["X"], 100)
    rows = spark.range(20).selectExpr(f"{d1} AS a", f"{d2} AS b").collect()
    assert all(r["a"] == "X" and r["b"] is None for r in rows)
    d1, d2 = D.draw_two_distinct(D.u(9, 'a', 'id'), "0.0D", D.u(9, 'c', 'id'), ["X", "Y"], 100)
    rows = spark.range(200).selectExpr(f"{d1} AS a", f"{d2} AS b").collect()
    assert all({r["a"], r["b"]} == {"X", "Y"} for r in rows)


def test_draws_do_not_depend_on_partitioning(spark):
    e = f"{D.u(10, 'p', 'id')} AS u"
    a = spark.range(0, 5000, 1, 1).selectExpr("id", e).orderBy("id").collect()
    b = spark.range(0, 5000, 1, 13).repartition(7).selectExpr("id", e).orderBy("id").collect()
    assert a == b


def test_trunc_normal_guide_table_inverts_the_law(spark):
    """The guide table gives the value that a search of all bounds gives, for uniforms on and beside every bound."""
    import bisect
    for mean, sd, lo, hi in ((45, 15, 0, 116), (45, 15, 23, 70), (44.5, 0.3, 40, 50), (0.0, 0.5, 0, 116), (45, 15, 80, 90), (5, 400, 0, 1000)):
        bounds = D.trunc_normal_bounds(mean, sd, lo, hi)
        below, inside = D.guide_table(bounds)
        assert len(below) == D.GUIDE and sum(inside) == sum(b <= 1 for b in bounds) - below[0]
        for u in [x for b in bounds for x in (math.nextafter(b, 0), b, math.nextafter(b, 2))] + [i / D.GUIDE for i in range(D.GUIDE)] + [math.nextafter(1, 0)]:
            if u < 1:
                i, want = int(u * D.GUIDE), bisect.bisect_right(bounds, u)
                if inside[i] < 2:
                    assert below[i] + (below[i] < len(bounds) and bounds[below[i]] <= u) == want
        rows = spark.range(20_000).selectExpr(f"{D.trunc_normal_int(9, 'g', 'id', mean, sd, lo, hi)} AS v", f"{D.u(9, 'g', 'id')} AS u").collect()
        assert all(r["v"] == lo + bisect.bisect_right(bounds, r["u"]) for r in rows)
