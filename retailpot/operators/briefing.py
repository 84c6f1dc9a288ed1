"""Deterministic briefing per outlet as JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retailpot.operators.serving import utilisation_pct

# --- fixed values: wording of the briefing ---------------------------------------------------
ALERTS = {
    "critical": (
        "🚨 Cooler Capacity Bottleneck Detected",
        "This outlet is operating at %s%% cooler capacity utilization. Physical infrastructure is constraining growth. "
        "The predicted potential of %sL cannot be achieved without additional cooler deployment."),
    "success": (
        "✅ High-Growth Opportunity Identified",
        "There is a significant %sL monthly volume gap (%s%% growth headroom) between current sales and predicted potential. "
        "This outlet is underperforming relative to its market opportunity."),
    "warning": (
        "⚠️ High Competition Market",
        "This outlet operates in a densely competitive market with %s competitors within 500m. "
        "Focus on customer retention and share-of-wallet strategies."),
    "info": (
        "ℹ️ Outlet Assessment Summary",
        "This outlet has a predicted monthly potential of %sL against a recent 3-month average of %sL."),
}
CARDS = {
    "budget": (
        "💰", "Investment Opportunity — %s Priority Budget",
        "This outlet has been selected for a LKR %s trade spend investment targeting a %sL volume gap. "
        "The recommended activity is %s, with an expected volume uplift of %sL per month."),
    "gap": (
        "📈", "Demand Gap Analysis",
        "The predicted maximum monthly potential is %sL, while the recent 3-month average sits at %sL — a gap of %sL "
        "(%s%% growth headroom). The true demand estimate of %sL suggests historical sales data may have "
        "underrepresented actual demand."),
    "cooler": (
        "❄️", "Cooler Infrastructure Status",
        "The outlet has a physical cooler capacity of %sL with a theoretical monthly ceiling of %sL. "
        "Current utilization is at %s%%%s."),
    "market": (
        "🏪", "Market Competition Landscape",
        "There are %s competitors within 500m and %s within 1km. The market is classified as \"%s\". %s"),
    "location": (
        "🚍", "Location & Foot Traffic",
        "The outlet benefits from a location traffic score of %s.%s%s%s"),
}
COOLER_HIGH = " — this is a bottleneck that requires immediate attention"
COOLER_LOW = " — significant room for growth without additional infrastructure"
MARKET_ADVICE = {
    "dense": "Focus on differentiation and customer loyalty programs.",
    "isolated": "Significant opportunity to capture unserved demand in this low-competition area.",
    "other": "A balanced competitive environment with room for strategic growth.",
}
LOCATION_HINTS = {
    "transport_gravity_score": " Strong transit hub proximity drives regular foot traffic.",
    "school_gravity_score": " Nearby educational facilities contribute to daily customer flow.",
    "worship_gravity_score": " Proximity to places of worship generates periodic high-traffic events.",
}
ACTIONS = {
    "deploy": "Deploy the LKR %s %s to unlock the estimated %sL monthly volume gap.",
    "cooler": "Prioritize cooler infrastructure expansion — current %s%% utilization is physically constraining volume growth.",
    "gap": "Target the %sL demand gap with optimized delivery scheduling and stock availability improvements.",
    "dense": "Implement customer retention tactics (loyalty incentives, competitive pricing) given the dense competitive "
             "environment with %s nearby competitors.",
    "isolated": "Expand outreach to capture unserved demand in this low-competition area — consider increased visibility "
                "and promotional activity.",
    "review": "Review and verify outlet performance against the %sL target in the next monthly sales review cycle.",
}
MAX_ENTRIES = 5
# ---------------------------------------------------------------------------------------------


def thousands(c: Column) -> Column:
    """Whole number with thousands separators, halves up."""
    return F.format_number(F.floor(F.coalesce(c, F.lit(0.0)) + 0.5).cast("long"), 0)


def _text(template: str, *args: Column) -> Column:
    return F.format_string(template, *[a.cast("string") for a in args])


def _alert(kind: str, *args: Column) -> Column:
    title, message = ALERTS[kind]
    return F.struct(F.lit(kind).alias("type"), F.lit(title).alias("title"), _text(message, *args).alias("message"))


def _card(kind: str, *args: Column, title: Column | None = None) -> Column:
    icon, heading, text = CARDS[kind]
    heading = F.lit(heading) if title is None else _text(heading, title)
    return F.struct(F.lit(icon).alias("icon"), heading.alias("title"), _text(text, *args).alias("description"))


def rule_briefing(detail: DataFrame) -> DataFrame:
    """(outlet_id, alert_type, n_cards, n_actions, briefing_json) from ``outlet_detail`` rows."""
    predicted, recent = F.col("predicted_potential_litres"), F.col("recent_3m_avg")
    gap = F.greatest(F.lit(0.0), predicted - recent)
    gap_pct = F.when(recent > 0, F.floor(gap / recent * 100.0 + 0.5)).otherwise(F.lit(0)).cast("long")
    util, market, b = utilisation_pct(), F.col("market_saturation_class"), F.col("budget_allocation")
    near, near_km = F.col("competitors_500m"), F.col("competitors_1km")
    has_budget, full = b.isNotNull(), util > 80
    dense, isolated = market == "dense", market == "isolated"

    alert = (F.when(full, _alert("critical", util, thousands(predicted)))
             .when((gap > 0) & (gap_pct > 30), _alert("success", thousands(gap), gap_pct))
             .when(dense, _alert("warning", near))
             .otherwise(_alert("info", thousands(predicted), thousands(recent))))

    activity = F.replace(b.recommended_spend_type, F.lit("_"), F.lit(" "))
    tier = F.concat(F.upper(F.left(b.allocation_tier, F.lit(1))), F.substring(b.allocation_tier, 2, 100))
    spend, target = thousands(b.trade_spend_allocation_lkr), thousands(b.uplift_gap_litres)
    cooler_note = F.when(full, COOLER_HIGH).when(util < 40, COOLER_LOW).otherwise("")
    advice = F.when(dense, MARKET_ADVICE["dense"]).when(isolated, MARKET_ADVICE["isolated"]).otherwise(MARKET_ADVICE["other"])
    hints = [F.when(F.col(c) > 1, text).otherwise("") for c, text in LOCATION_HINTS.items()]
    score = F.col("composite_gravity_score")
    cards = F.array_compact(F.array(
        F.when(has_budget, _card("budget", spend, target, activity, thousands(b.projected_volume_uplift_litres), title=tier)),
        _card("gap", thousands(predicted), thousands(recent), thousands(gap), gap_pct, thousands(F.col("tobit_latent_estimate"))),
        _card("cooler", thousands(F.col("cooler_capacity_litres")), thousands(F.col("theoretical_monthly_ceiling")), util, cooler_note),
        F.when(near > 0, _card("market", near, near_km, market, advice)),
        F.when(score > 0, _card("location", F.format_string("%.1f", score), *hints))))

    actions = F.array_compact(F.array(
        F.when(has_budget, _text(ACTIONS["deploy"], spend, activity, target)),
        F.when(full, _text(ACTIONS["cooler"], util)),
        F.when(gap > 0, _text(ACTIONS["gap"], thousands(gap))),
        F.when(dense, _text(ACTIONS["dense"], near)).when(isolated, F.lit(ACTIONS["isolated"])),
        _text(ACTIONS["review"], thousands(predicted))))

    pack = F.struct(alert.alias("diagnostic_alert"), F.slice(cards, 1, MAX_ENTRIES).alias("driver_cards"),
                    F.slice(actions, 1, MAX_ENTRIES).alias("action_checklist"))
    return detail.select("outlet_id", pack.alias("p")).select(
        "outlet_id", F.col("p.diagnostic_alert.type").alias("alert_type"), F.size("p.driver_cards").alias("n_cards"),
        F.size("p.action_checklist").alias("n_actions"), F.to_json("p").alias("briefing_json"))
