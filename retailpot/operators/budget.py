"""Spread a fixed budget over ranked outlets.

The cohort is ranked once at scale; every later step is a row expression or a running sum over the
rank, computed in bounded blocks. Steps of spend and limits are multiples of ``Budget.step`` and all
rows of a tier share one floor; under these two conditions the running-sum form gives what a
sequential walk gives.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retailpot.config import TIER_PARAMETERS, Budget
from retailpot.functions.numeric import literal_map, scalar_struct
from retailpot.operators import quality as q
from retailpot.operators.ranking import global_row_number, running_sum
from retailpot.session import cut

SPEND = "Trade_Spend_Allocation_LKR"
RANK = "roi_rank"
REBALANCE_PASSES = 10
DIAGNOSTIC_COLUMNS = (
    "Outlet_ID", "province", "distributor_id", "Outlet_Size", "Outlet_Type", "uplift_gap_litres",
    "composite_gravity_score", "competition_density_score", "roi_score", "roi_rank", "allocation_tier",
    "recommended_spend_type", SPEND, "projected_volume_uplift_litres",
)


def uplift_gap(master: DataFrame, predictions: DataFrame, budget: Budget) -> DataFrame:
    """Outlets of the cohort with their gap between potential and recent sales."""
    df = master.where(F.col("distributor_id").isin(*budget.cohort)).join(predictions.select("Outlet_ID", "Maximum_Monthly_Liters"), "Outlet_ID")
    return df.withColumn("uplift_gap_litres", F.greatest(F.col("Maximum_Monthly_Liters") - F.col("recent_3m_avg"), F.lit(0.0)))


def roi_score(df: DataFrame, use_coolers: bool = True) -> DataFrame:
    """Weighted min-max score; a constant input counts 0. ``use_coolers=False`` gives the cooler term no effect."""
    terms = {"uplift_gap_litres": 0.40, "composite_gravity_score": 0.30, "recent_3m_avg": 0.20}
    if use_coolers:
        terms["Cooler_Count"] = 0.10
    r = scalar_struct(df, **{f"lo_{c}": F.min(c).cast("double") for c in terms}, **{f"hi_{c}": F.max(c).cast("double") for c in terms})

    def norm(c: str) -> Column:
        lo, hi = r.getField(f"lo_{c}"), r.getField(f"hi_{c}")
        return F.when(hi - lo == 0, F.lit(0.0)).otherwise((F.col(c) - lo) / (hi - lo + F.lit(1e-9)))

    score = None
    for c, w in terms.items():
        score = F.lit(w) * norm(c) if score is None else score + F.lit(w) * norm(c)
    return df.withColumn("roi_score", score)


def roi_rank_tiers(df: DataFrame, budget: Budget) -> DataFrame:
    """Rank by score (ties by id) and cut tiers at integer shares of the cohort."""
    ranked = global_row_number(df, [F.col("roi_score").desc(), F.col("Outlet_ID")], RANK)
    n = ranked.agg(F.count("*")).scalar()
    tier, end = None, F.lit(0)
    for name, share in budget.tier_shares:
        end = end + F.floor(n * F.lit(share))
        tier = F.when(F.col(RANK) <= end, name) if tier is None else tier.when(F.col(RANK) <= end, name)
    return ranked.withColumn("allocation_tier", tier.otherwise("None"))


def tier_guardrails(df: DataFrame) -> DataFrame:
    """No activity: None. No history, small shops, kiosks and pharmacies: Medium at most."""
    t = F.col("allocation_tier")
    idle = (F.col("recent_3m_avg") == 0) | (F.col("uplift_gap_litres") == 0)
    capped = ~F.col("has_transaction_history") | (F.col("Outlet_Size") == "Small") | F.col("Outlet_Type").isin("Kiosk", "Pharmacy")
    return df.withColumn("allocation_tier", F.when(idle, "None").when(capped & (t == "High"), "Medium").otherwise(t))


def tier_parameters(df: DataFrame) -> DataFrame:
    names = ("tier_cap", "tier_floor", "volume_per_lkr", "recommended_spend_type")
    return df.withColumns({n: literal_map(F.col("allocation_tier"), {t: p[i] for t, p in TIER_PARAMETERS.items()}) for i, n in enumerate(names)})


def headroom_limit(df: DataFrame, budget: Budget) -> DataFrame:
    """Largest useful spend, to the nearest step (ties to even); below the floor the outlet leaves its tier."""
    limit = F.when(F.col("volume_per_lkr") > 0, F.least(F.col("tier_cap"), F.col("uplift_gap_litres") / F.col("volume_per_lkr"))).otherwise(F.lit(0.0))
    limit = F.rint(limit / F.lit(budget.step)) * F.lit(budget.step)
    out = df.withColumn("max_headroom_allocation", limit)
    low = F.col("max_headroom_allocation") < F.col("tier_floor")
    return out.withColumns({"max_headroom_allocation": F.when(low, F.lit(0.0)).otherwise(F.col("max_headroom_allocation")),
                            "allocation_tier": F.when(low, "None").otherwise(F.col("allocation_tier")),
                            "recommended_spend_type": F.when(low, "None").otherwise(F.col("recommended_spend_type"))})


def greedy_tier_budget(df: DataFrame, budget: Budget) -> DataFrame:
    """Walk each tier by rank and spend from its bucket."""
    want = F.when(F.col("allocation_tier") == "None", F.lit(0.0)).otherwise(F.col("max_headroom_allocation"))
    out = running_sum(df, RANK, want, "_prev", ["allocation_tier"], rows=df.count())
    bucket = literal_map(F.col("allocation_tier"), budget.buckets, 0.0)
    spend = F.least(want, F.greatest(F.lit(0.0), bucket - F.col("_prev")))
    return out.withColumn(SPEND, F.when((spend > 0) & (spend >= F.col("tier_floor")), spend).otherwise(F.lit(0.0))).drop("_prev")


def _stepped(df: DataFrame, eligible: Column, amount: Column, step: float, rows: int) -> DataFrame:
    """Add one step to the first ``floor(amount / step)`` eligible rows by rank."""
    out = running_sum(df.withColumn("_e", F.coalesce(eligible, F.lit(False)).cast("int")), RANK, F.col("_e"), "_before", rows=rows)
    hit = (F.col("_e") == 1) & (F.col("_before") < F.floor(amount / F.lit(abs(step))))
    return out.withColumn(SPEND, F.when(hit, F.col(SPEND) + F.lit(step)).otherwise(F.col(SPEND))).drop("_e", "_before")


def leftover_redistribution(df: DataFrame, budget: Budget) -> DataFrame:
    """One step to High outlets with room below the tier cap, then one to any funded outlet with room."""
    s, rows = F.lit(budget.step), df.count()
    room = (F.col(SPEND) > 0) & (F.col(SPEND) + s <= F.col("tier_cap"))
    for extra in (F.col("allocation_tier") == "High", F.lit(True)):
        left = F.lit(budget.total) - df.agg(F.coalesce(F.sum(SPEND), F.lit(0.0))).scalar()
        df = _stepped(df, room & extra, left, budget.step, rows)
    return df


class Queue:
    """Rows of one distributor in the order in which they give or get; only the first one changes until it leaves."""

    def __init__(self, rows: list, spend: str = SPEND):
        self.rows, self.at = rows, 0
        self.spend = rows[0][spend] if rows else 0.0

    @property
    def row(self):
        return self.rows[self.at] if self.at < len(self.rows) else None

    def move(self, spend: float, stays: bool) -> None:
        self.spend = spend
        if not stays:
            self.at += 1
            self.spend = self.row[SPEND] if self.row is not None else 0.0


def rebalance_walk(totals: dict, under: list, over: list, sources: dict[str, Queue], targets: dict[str, Queue], minimum: float, step: float) -> dict:
    """New spend by rank. Merges two ordered event sequences, what sources give and what targets get, one payment after another.

    A payment goes from the richest distributor above the minimum to the one below it: a step, or the tier floor to a target that has
    nothing yet. A source that a payment would take below its own floor gives all it has and drops to zero.
    """
    changed = {}
    for d in under:
        queue = targets[d]
        while totals[d] < minimum:
            giver = max(over, key=lambda o: totals[o], default=None)
            source, target = sources[giver].row if giver is not None else None, queue.row
            if source is None or target is None:
                break
            have, got = sources[giver].spend, queue.spend
            pay = target.tier_floor if got == 0 else step
            if have - pay < source.tier_floor:
                pay = have
            changed[source[RANK]], changed[target[RANK]] = have - pay, got + pay
            totals[giver], totals[d] = totals[giver] - pay, totals[d] + pay
            sources[giver].move(have - pay, have - pay > source.tier_floor)
            queue.move(got + pay, got + pay < target.max_headroom_allocation)
    return changed


def distributor_rebalance(df: DataFrame, budget: Budget) -> DataFrame:
    """Lift every cohort distributor to its minimum share.

    In up to ``REBALANCE_PASSES`` passes, spend moves from the richest distributor above the minimum to each one below it: taken from the
    lowest score with more than its floor, given to the highest score with room (equal scores by rank). The walk itself depends on each
    payment before it. A payment moves a step at least, so it touches no more rows of a distributor than the deficit holds steps: that
    many (``total / step`` at most, whatever the number of outlets) are taken in order by Spark, walked, and joined back.
    """
    step, minimum, spend = budget.step, budget.min_share * budget.total, F.col(SPEND)
    columns = [RANK, SPEND, "tier_floor", "max_headroom_allocation"]
    for _ in range(REBALANCE_PASSES):
        have = {r.distributor_id: r.s for r in df.where(F.col("distributor_id").isin(*budget.cohort)).groupBy("distributor_id").agg(F.sum(SPEND).alias("s")).collect()}
        totals = {d: have.get(d) or 0.0 for d in budget.cohort}
        under, over = [d for d in budget.cohort if totals[d] < minimum], [d for d in budget.cohort if totals[d] > minimum]
        if not under or not over:
            return df
        steps = sum(math.ceil((minimum - totals[d]) / step) for d in under)

        def first(d: str, rows, *order) -> Queue:
            own = df.where((F.col("distributor_id") == d) & rows)
            return Queue(own.orderBy(*order, RANK).limit(steps).select(*columns).collect())

        sources = {d: first(d, spend > F.col("tier_floor"), F.asc("roi_score")) for d in over}
        targets = {d: first(d, (spend < F.col("max_headroom_allocation")) & (F.col("max_headroom_allocation") > 0), F.desc("roi_score")) for d in under}
        changed = rebalance_walk(totals, under, over, sources, targets, minimum, step)
        if not changed:
            return df
        new = df.sparkSession.createDataFrame(list(changed.items()), f"{RANK} long, _new double")
        df = cut(df.join(new, RANK, "left").withColumn(SPEND, F.coalesce("_new", SPEND)).drop("_new"))
    return df


def micro_adjust(df: DataFrame, budget: Budget) -> DataFrame:
    """Reach the exact total with single steps in score order, inside cap and floor."""
    s, spend, rows = F.lit(budget.step), F.col(SPEND), df.count()
    for sign in (1, -1):
        gap = (F.lit(budget.total) - df.agg(F.coalesce(F.sum(SPEND), F.lit(0.0))).scalar()) * F.lit(float(sign))
        if sign > 0:
            ok = (spend > 0) & (spend + s <= F.least(F.col("tier_cap"), F.col("max_headroom_allocation") + 100.0))
        else:
            ok = (spend > F.col("tier_floor")) & (spend >= s)
        df = _stepped(df, ok, F.greatest(gap, F.lit(0.0)), sign * budget.step, rows)
    return df


def projected_uplift(df: DataFrame) -> DataFrame:
    none = F.col(SPEND) == 0
    return df.withColumns({"projected_volume_uplift_litres": F.col(SPEND) * F.col("volume_per_lkr"),
                           "allocation_tier": F.when(none, "None").otherwise(F.col("allocation_tier")),
                           "recommended_spend_type": F.when(none, "None").otherwise(F.col("recommended_spend_type"))})


def limits(master: DataFrame, predictions: DataFrame, budget: Budget) -> DataFrame:
    """Everything up to the spending limit per outlet."""
    ranked = roi_rank_tiers(roi_score(uplift_gap(master, predictions, budget)), budget)
    return headroom_limit(tier_parameters(tier_guardrails(ranked)), budget)


def allocate(limited: DataFrame, budget: Budget) -> DataFrame:
    """All spending steps; each is stored before the next, which reads it several times."""
    df = cut(limited)
    for step in (greedy_tier_budget, leftover_redistribution, distributor_rebalance, micro_adjust):
        df = cut(step(df, budget))
    return projected_uplift(df)


def allocation_checks(df: DataFrame, budget: Budget) -> DataFrame:
    """Business rules on the final allocation, one row per rule."""
    spend, total, zero = F.col(SPEND), F.sum(SPEND), F.lit(0.0)
    small = (F.col("Outlet_Size") == "Small") | F.col("Outlet_Type").isin("Kiosk", "Pharmacy")
    rows = q.expect(df, [
        q.Rule("no_spend_1_499", (spend > 0) & (spend < 500.0)),
        q.Rule("within_headroom_plus_100", spend > F.col("max_headroom_allocation") + 100.0),
        q.Rule("small_outlets_max_3000", small & (spend > 3000.0)),
        q.Rule("multiple_of_step", spend % budget.step != 0),
    ])
    share = F.sum(F.when(F.col("allocation_tier").isin("High", "Medium"), spend).otherwise(zero))
    one = df.agg(
        (F.abs(F.coalesce(total, zero) - budget.total) > 0.005).cast("long").alias("exact_total"),
        (F.coalesce(share, zero) < budget.min_high_medium_share * budget.total).cast("long").alias("high_medium_share"),
        (F.count_if(spend > 0) < budget.min_funded).cast("long").alias("coverage"),
        *[(F.coalesce(F.sum(F.when(F.col("distributor_id") == d, spend)), zero) < budget.min_share * budget.total - 1.0)
          .cast("long").alias(f"min_share:{d}") for d in budget.cohort])
    whole = one.select(F.explode(F.array(*[F.struct(F.lit(c).alias("rule"), F.col(f"`{c}`").alias("violations")) for c in one.columns])).alias("x")).select(
        "x.*").withColumn("ok", F.col("violations") == 0)
    return rows.unionByName(whole)


def roi_histogram(df: DataFrame, bins: int = 60) -> DataFrame:
    """Counts of positive scores in equal bins with the lowest score per tier on each row's tier."""
    pos = df.where("roi_score > 0")
    r = scalar_struct(pos, lo=F.min("roi_score"), hi=F.max("roi_score"))
    lo, hi = r.getField("lo"), r.getField("hi")
    width = (hi - lo) / F.lit(float(bins))
    b = F.when(hi > lo, F.least(F.floor((F.col("roi_score") - lo) / width), F.lit(bins - 1))).otherwise(F.lit(0))
    return pos.groupBy(b.cast("int").alias("bin")).agg(F.count("*").alias("n"), *[
        F.min(F.when(F.col("allocation_tier") == t, F.col("roi_score"))).alias(f"min_{t.lower()}") for t in ("High", "Medium", "Low")])
