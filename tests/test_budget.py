import random

import pytest
from pyspark.sql import functions as F

from retailpot.config import Budget
from retailpot.operators import budget as b
from retailpot.operators import ranking

SCHEMA = ("Outlet_ID string, distributor_id string, roi_rank long, allocation_tier string, tier_cap double, tier_floor double, volume_per_lkr double, "
          "recommended_spend_type string, max_headroom_allocation double, Outlet_Size string, Outlet_Type string, roi_score double")
PARAMS = {"High": (12000.0, 2000.0, 0.028), "Medium": (3000.0, 500.0, 0.012), "Low": (800.0, 500.0, 0.004), "None": (0.0, 0.0, 0.0)}


def cohort(seed, n=160):
    rng, out = random.Random(seed), []
    for i in range(n):
        t = rng.choice(["High", "Medium", "Medium", "Low", "None"])
        cap, floor, eff = PARAMS[t]
        room = 0.0 if t == "None" else 50.0 * rng.randint(int(floor / 50), int(cap / 50))
        d = rng.choices(["DIST_W_01", "DIST_W_02", "DIST_W_03"], [8, 3, 1])[0]
        out.append((f"o{i:04d}", d, i + 1, t, cap, floor, eff, "x", room, rng.choice(["Small", "Large"]), "Grocery", 1 - i / n))
    return out


def walk(data, buckets):
    left, spend = dict(buckets), []
    for r in data:
        s = min(r[8], left.get(r[3], 0.0)) if r[3] != "None" else 0.0
        s = 0.0 if s < r[5] or s <= 0 else s
        left[r[3]] = left.get(r[3], 0.0) - s
        spend.append(s)
    return spend, sum(left[t] for t in buckets)


def redistribute(data, spend, diff):
    for only_high in (True, False):
        for i, r in enumerate(data):
            if diff >= 50 and spend[i] > 0 and (r[3] == "High" or not only_high) and spend[i] + 50 <= r[4]:
                spend[i] += 50
                diff -= 50
    return spend


def collect(df):
    return [r[b.SPEND] for r in df.orderBy("roi_rank").collect()]


@pytest.mark.parametrize("seed,block", [(1, 1 << 16), (2, 16), (3, 7)])
def test_running_sums_equal_the_sequential_walk(spark, monkeypatch, seed, block):
    monkeypatch.setattr(ranking, "BLOCK", block)
    monkeypatch.setattr(ranking.running_sum, "__defaults__", ((), block, None))
    data, money = cohort(seed), Budget(buckets={"High": 90_050.0, "Medium": 50_000.0, "Low": 4_300.0})
    df = spark.createDataFrame(data, SCHEMA)
    spend, left = walk(data, money.buckets)
    greedy = b.greedy_tier_budget(df, money)
    assert collect(greedy) == spend
    assert collect(b.leftover_redistribution(greedy, money)) == redistribute(data, spend, left)


@pytest.mark.parametrize("seed", [4, 5])
def test_rebalance_and_adjust_keep_the_rules(spark, seed):
    data, money = cohort(seed, 240), Budget(buckets={"High": 150_000.0, "Medium": 60_000.0, "Low": 5_000.0}, min_share=0.2, min_funded=10)
    spread = b.leftover_redistribution(b.greedy_tier_budget(spark.createDataFrame(data, SCHEMA), money), money)
    before = {r.distributor_id: r.s for r in spread.groupBy("distributor_id").agg(F.sum(b.SPEND).alias("s")).collect()}
    balanced = b.distributor_rebalance(spread, money).checkpoint()
    assert balanced.agg(F.sum(b.SPEND)).first()[0] == spread.agg(F.sum(b.SPEND)).first()[0]
    after = {r.distributor_id: r.s for r in balanced.groupBy("distributor_id").agg(F.sum(b.SPEND).alias("s")).collect()}
    minimum = money.min_share * money.total
    for d, s in before.items():
        assert after[d] >= min(s, minimum) - 1e-9
    assert min(before.values()) < minimum  # the case is not empty
    assert after[min(before, key=before.get)] > min(before.values())
    bad = balanced.where(f"{b.SPEND} > 0 and {b.SPEND} < tier_floor or {b.SPEND} > greatest(max_headroom_allocation, tier_cap)")
    dropped = spread.where(f"{b.SPEND} > 0").join(balanced.where(f"{b.SPEND} = 0"), "Outlet_ID", "left_semi")
    assert bad.count() <= dropped.count()   # only the last spend of a source that dropped to zero may miss a target's floor
    final = b.projected_uplift(b.micro_adjust(balanced, money))
    checks = {r.rule: r.ok for r in b.allocation_checks(final, money).collect()}
    assert checks["exact_total"] and checks["no_spend_1_499"] and checks["multiple_of_step"] and checks["coverage"]
    assert final.where(f"{b.SPEND} = 0 and allocation_tier <> 'None'").count() == 0


def test_an_unfunded_target_gets_its_floor(spark):
    """W_01 has 1,500 and needs 2,500; its first target is unfunded with a floor of 2,000; W_02 has plenty to spare."""
    rows = [("a", "DIST_W_01", 1, "High", 12000.0, 2000.0, 0.028, "x", 12000.0, "Large", "Grocery", 0.9, 0.0),
            ("b", "DIST_W_01", 2, "Medium", 3000.0, 500.0, 0.012, "x", 3000.0, "Large", "Grocery", 0.8, 1500.0),
            ("c", "DIST_W_02", 3, "Medium", 12000.0, 500.0, 0.012, "x", 9000.0, "Large", "Grocery", 0.7, 6000.0),
            ("d", "DIST_W_03", 4, "Medium", 3000.0, 500.0, 0.012, "x", 3000.0, "Large", "Grocery", 0.6, 2500.0)]
    money = Budget(buckets={"High": 5000.0, "Medium": 5000.0}, min_share=0.25)
    got = {r.Outlet_ID: r[b.SPEND] for r in b.distributor_rebalance(spark.createDataFrame(rows, SCHEMA + f", {b.SPEND} double"), money).collect()}
    assert got == {"a": 2000.0, "b": 1500.0, "c": 4000.0, "d": 2500.0}


@pytest.mark.parametrize("seed", range(6))
def test_minimum_share_is_reached_where_slack_and_room_suffice(spark, seed):
    data, money = cohort(seed + 20, 120), Budget(buckets={"High": 120_000.0, "Medium": 50_000.0, "Low": 5_000.0}, min_share=0.2)
    start = b.leftover_redistribution(b.greedy_tier_budget(spark.createDataFrame(data, SCHEMA), money), money).collect()
    rows = [[r.Outlet_ID, r.distributor_id, r[b.SPEND], r.tier_floor, r.max_headroom_allocation] for r in start]
    frame = spark.createDataFrame(start, b.greedy_tier_budget(spark.createDataFrame(data, SCHEMA), money).schema)
    after = {r.Outlet_ID: r[b.SPEND] for r in b.distributor_rebalance(frame, money).collect()}
    least, have = money.min_share * money.total, {}
    for _, d, s, _, _ in rows:
        have[d] = have.get(d, 0) + s
    can = sum(min(max(0, (have[d] - least) // 50 * 50), sum(max(0, s - f) for _, e, s, f, _ in rows if e == d and s > 0)) for d in have)
    need = {d: -(-(least - v) // 50) * 50 for d, v in have.items() if v < least}
    room = {d: sum(max(0, h - s) for _, e, s, _, h in rows if e == d) for d in need}
    share = {d: sum(after[i] for i, e, *_ in rows if e == d) for d in have}
    assert sum(after.values()) == sum(have.values())
    if need and can >= sum(need.values()) + 2000 * len(need) and all(room[d] >= need[d] for d in need):
        assert all(share[d] >= least for d in need)
    dropped = sum(s > 0 and after[i] == 0 for i, _, s, _, _ in rows)
    assert sum(0 < after[i] < f for i, _, _, f, _ in rows) <= dropped


def plain_walk(rows, cohort, minimum):
    """The rules of the walk taken literally: every payment looks at all rows. ``rows``: [distributor, spend, floor, headroom, score]."""
    for _ in range(10):
        total = lambda d: sum(r[1] for r in rows if r[0] == d)
        under, over = [d for d in cohort if total(d) < minimum], [d for d in cohort if total(d) > minimum]
        if not under:
            break
        for d in under:
            while total(d) < minimum and over:
                giver = max(over, key=total)
                sources = [r for r in rows if r[0] == giver and r[1] > r[2]]
                targets = [r for r in rows if r[0] == d and r[1] < r[3] and r[3] > 0]
                if not sources or not targets:
                    break
                source, target = min(sources, key=lambda r: r[4]), max(targets, key=lambda r: r[4])
                first = target[2] if target[1] == 0 else 50.0
                source[1] -= first
                target[1] += first
                if source[1] < source[2]:
                    target[1] += source[1]
                    source[1] = 0.0
    return [r[1] for r in rows]


@pytest.mark.parametrize("seed", range(8))
def test_rebalance_equals_the_sequential_walk(spark, seed):
    rng = random.Random(seed + 100)
    data, money = cohort(seed + 40, 90), Budget(buckets={"High": 90_000.0, "Medium": 40_000.0, "Low": 5_000.0}, min_share=rng.choice([0.2, 0.25, 0.3, 0.33]))
    rows = []
    for r in data:
        r = list(r)
        r[1] = rng.choices(["DIST_W_01", "DIST_W_02", "DIST_W_03"], [[8, 3, 1], [1, 1, 1], [1, 9, 9], [5, 5, 1]][seed % 4])[0]
        r[11] = round(1 - r[2] / 90, 1)   # equal scores
        spend = 0.0 if rng.random() < 0.4 or r[8] == 0 else max(r[5], min(r[8], 50.0 * rng.randint(int(r[5] / 50), int(r[8] / 50) + 1)))
        rows.append((*r, spend))
    if seed == 7:
        rows = [r for r in rows if r[1] != "DIST_W_02"]   # a distributor without outlets
    minimum = money.min_share * sum(r[12] for r in rows) // 50 * 50
    money = Budget(buckets={"High": minimum / money.min_share}, min_share=money.min_share)
    got = collect(b.distributor_rebalance(spark.createDataFrame(rows, SCHEMA + f", {b.SPEND} double").repartition(3), money))
    assert got == plain_walk([[r[1], r[12], r[5], r[8], r[11]] for r in rows], money.cohort, money.min_share * money.total)
    assert sum(got) == sum(r[12] for r in rows)


def test_a_source_below_its_floor_gives_all_it_has(spark):
    """c can give 50 above its floor, the first payment to a is 2,000: c drops to zero and a gets its 550; d then pays by steps."""
    rows = [("a", "DIST_W_01", 1, "High", 12000.0, 2000.0, 0.028, "x", 12000.0, "Large", "Grocery", 0.9, 0.0),
            ("b", "DIST_W_02", 2, "Medium", 3000.0, 500.0, 0.012, "x", 3000.0, "Large", "Grocery", 0.8, 2850.0),
            ("c", "DIST_W_02", 3, "Medium", 3000.0, 500.0, 0.012, "x", 3000.0, "Large", "Grocery", 0.7, 550.0)]
    money = Budget(buckets={"High": 3400.0}, min_share=0.25)
    got = {r.Outlet_ID: r[b.SPEND] for r in b.distributor_rebalance(spark.createDataFrame(rows, SCHEMA + f", {b.SPEND} double"), money).collect()}
    assert got == {"a": 850.0, "b": 2550.0, "c": 0.0}


def test_allocate_reads_its_input_a_few_times(spark):
    money = Budget(buckets={"High": 90_000.0, "Medium": 50_000.0, "Low": 5_000.0})
    out = b.allocate(spark.createDataFrame(cohort(3), SCHEMA), money)
    assert len(out._jdf.queryExecution().optimizedPlan().toString()) < 20_000


def test_surplus_is_taken_back(spark):
    data = [(f"o{i}", "DIST_W_01", i + 1, "Medium", 3000.0, 500.0, 0.012, "x", 1000.0, "Large", "Grocery", 0.5) for i in range(4)]
    df = spark.createDataFrame(data, SCHEMA).withColumn(b.SPEND, F.lit(1000.0))
    assert collect(b.micro_adjust(df, Budget(buckets={"Medium": 3900.0}))) == [950.0, 950.0, 1000.0, 1000.0]
    assert collect(b.micro_adjust(df, Budget(buckets={"Medium": 4100.0}))) == [1050.0, 1050.0, 1000.0, 1000.0]


def test_scores_tiers_and_limits(spark):
    n = 40
    master = spark.createDataFrame([(f"o{i:02d}", "DIST_W_01" if i < n else "DIST_C_01", float(i % 7), 50.0, 2, True, "Small" if i % 4 == 0 else "Large", "Grocery") for i in range(n + 3)],
                                   "Outlet_ID string, distributor_id string, recent_3m_avg double, composite_gravity_score double, Cooler_Count int, has_transaction_history boolean, Outlet_Size string, Outlet_Type string")
    preds = spark.createDataFrame([(f"o{i:02d}", 5.0 + i) for i in range(n + 3)], "Outlet_ID string, Maximum_Monthly_Liters double")
    money = Budget()
    ranked = b.roi_rank_tiers(b.roi_score(b.uplift_gap(master, preds, money)), money)
    tiers = [r.allocation_tier for r in ranked.orderBy("roi_rank").collect()]
    assert tiers == ["High"] * 6 + ["Medium"] * 14 + ["Low"] * 6 + ["None"] * 14
    limited = b.headroom_limit(b.tier_parameters(b.tier_guardrails(ranked)), money)
    for r in limited.collect():
        assert r.max_headroom_allocation % 50 == 0 and (r.max_headroom_allocation == 0) == (r.allocation_tier == "None")
        assert not (r.allocation_tier == "High" and r.Outlet_Size == "Small") and not (r.recent_3m_avg == 0 and r.allocation_tier != "None")
    constant = b.roi_score(b.uplift_gap(master.withColumns({"recent_3m_avg": F.lit(1.0)}), preds.withColumn("Maximum_Monthly_Liters", F.lit(9.0)), money))
    assert {r.roi_score for r in constant.collect()} == {0.0}
    assert b.roi_histogram(limited).agg(F.sum("n")).first()[0] == limited.where("roi_score > 0").count()
