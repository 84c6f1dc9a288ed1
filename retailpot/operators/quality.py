"""Data-quality checks that split a table into passed and quarantined rows.

A run annotates every row once with the first check it fails (``_check``) and why
(``failure_reason``). Passed rows, quarantined rows and the report are all views of that one plan;
nothing is counted or collected on the way.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retailpot.functions.numeric import is_blank, title_case

log = logging.getLogger(__name__)
REASON, CHECK = "failure_reason", "_check"
HOT_ROWS = 200_000   # rows of a key that one task may number
BUCKETS = 1 << 15    # hashes of a key that are counted


@dataclass(frozen=True)
class Check:
    """``reason`` is a row-local column (null = pass) or a function adding ``_reason`` to a frame."""

    name: str
    reason: Column | Callable[[DataFrame], DataFrame]


def _require(df: DataFrame, columns: Sequence[str]) -> None:
    for c in columns:
        if c not in df.columns:
            raise ValueError(f"Column '{c}' not found; available: {df.columns}")


def evenly_spread(df: DataFrame, column: str, rows: int = HOT_ROWS) -> bool:
    """Whether no value of ``column`` (null included) holds more than ``rows`` rows.

    Rows are counted by the value's hash, so what is shuffled is bounded however many values there are; values that share a hash count together.
    """
    counts = df.groupBy(F.pmod(F.xxhash64(column), F.lit(BUCKETS)).alias("_hash")).agg(F.count("*").alias("n"))
    return (counts.agg(F.max("n")).first()[0] or 0) <= rows


def duplicate_check(keys: Sequence[str], row_id: str, keep: str | bool = "first",
                    order_by: Sequence[str] = (), salts: int = 64, cluster: str | None = None, hot_rows: int = HOT_ROWS) -> Check:
    """All rows of a key but one fail (``keep=False``: all rows of a repeated key fail); nulls are equal.

    Rows are numbered within (key, salt) first; only the first of each salt is then compared within the
    key. A key that holds a large share of the rows is thus spread over ``salts`` tasks, and the second
    step sees at most ``salts`` rows of it.

    With ``cluster``, one of the keys, its rows are counted first. Where no value holds over ``hot_rows``, rows are dealt by that column
    alone and numbered at once: one shuffle, which later joins on the column share.
    """

    def annotate(df: DataFrame) -> DataFrame:
        _require(df, [*keys, row_id])
        order = [F.col(c) for c in (*order_by, row_id)]
        order = [c.desc() for c in order] if keep == "last" else order
        dead = F.col(REASON).isNotNull()  # rows that failed before are kept apart from the living
        if cluster and evenly_spread(df, cluster, hot_rows):
            same = Window.partitionBy(*keys, dead)
            stays = F.count("*").over(same) == 1 if keep is False else F.row_number().over(same.orderBy(*order)) == 1
            dealt = df.repartition(cluster).withColumn("_stays", stays)
            return dealt.withColumn("_reason", F.when(~F.col("_stays"), F.lit("duplicate_record"))).drop("_stays")
        salted = df.withColumn("_salt", F.pmod(F.xxhash64(row_id), F.lit(salts)))
        near = Window.partitionBy(*keys, dead, "_salt")
        salted = salted.withColumn("_rn", F.row_number().over(near.orderBy(*order)))
        if keep is False:
            salted = salted.withColumn("_n", F.count("*").over(near))
        far = Window.partitionBy(*keys, dead, F.when(F.col("_rn") > 1, F.col("_salt")))
        single = F.row_number().over(far.orderBy(*order)) == 1
        if keep is False:
            single = F.sum("_n").over(far) == 1
        first = (F.col("_rn") == 1) & F.col("_single")
        return (salted.withColumn("_single", single).withColumn("_reason", F.when(~first, F.lit("duplicate_record")))
                .drop("_salt", "_rn", "_n", "_single"))

    return Check("duplicate_check", annotate)


def null_check(columns: Sequence[str]) -> Check:
    """Null or blank mandatory fields; the reason names the first one."""
    if not columns:
        log.warning("null_check without columns: all rows pass")
        return Check("null_check", F.lit(None).cast("string"))
    reason = F.coalesce(*[F.when(is_blank(F.col(c)), F.lit(f"null_in_mandatory_field:{c}")) for c in columns])
    return Check("null_check", reason)


def ref_integrity_check(fk: str, ref: DataFrame, ref_col: str) -> Check:
    """Null and unknown foreign keys fail with different reasons."""

    def annotate(df: DataFrame) -> DataFrame:
        _require(df, [fk])
        known = ref.select(F.col(ref_col).alias(fk)).where(F.col(fk).isNotNull()).distinct().withColumn("_known", F.lit(True))
        reason = F.when(F.col(fk).isNull(), F.lit(f"null_foreign_key:{fk}")).when(
            F.col("_known").isNull(), F.lit(f"referential_integrity_violation:{fk}"))
        return df.join(known, fk, "left").withColumn("_reason", reason).drop("_known")

    return Check("ref_integrity_check", annotate)


def range_check(column: str, low=None, high=None, inclusive: bool = True) -> Check:
    """Values outside the bounds fail with the value in the reason; null fails on its own."""
    if low is None and high is None:
        log.warning("range_check without bounds: all rows pass")
        return Check("range_check", F.lit(None).cast("string"))
    c, tests = F.col(column), []
    if low is not None:
        tests.append(c < low if inclusive else c <= low)
    if high is not None:
        tests.append(c > high if inclusive else c >= high)
    outside = reduce(lambda a, b: a | b, tests)
    reason = F.when(c.isNull(), F.lit(f"null_in_range_col:{column}")).when(
        outside, F.concat(F.lit(f"out_of_range:{column}:value="), c.cast("string")))
    return Check("range_check", reason)


def format_check(column: str, pattern: str) -> Check:
    """The whole text must match ``pattern``."""
    c = F.col(column)
    reason = F.when(c.isNull(), F.lit(f"null_in_format_col:{column}")).when(
        ~c.cast("string").rlike(rf"\A(?:{pattern})\z"), F.lit(f"format_violation:{column}:pattern={pattern}"))
    return Check("format_check", reason)


def value_set_check(column: str, values: Sequence, case_sensitive: bool = True) -> Check:
    """Membership; null is not a member."""
    c = F.col(column)
    member = c.isin(*values) if case_sensitive else F.lower(c.cast("string")).isin(*[str(v).lower() for v in values])
    reason = F.when(~F.coalesce(member, F.lit(False)), F.concat(
        F.lit(f"invalid_value:{column}:found="), F.coalesce(c.cast("string"), F.lit("None"))))
    return Check("value_set_check", reason)


def condition_check(name: str, violated: Column, reason: str | Column) -> Check:
    """Any other row rule, e.g. zero coordinates or a bounding box."""
    reason = F.lit(reason) if isinstance(reason, str) else reason
    return Check(name, F.when(F.coalesce(violated, F.lit(False)), reason))


def without_value(reason: str) -> Column:
    """The reason without the row's value: one of a few texts however large the data."""
    return F.regexp_replace(reason, r"(?s):(value|found)=.*$", "")


@dataclass(frozen=True)
class CheckRun:
    annotated: DataFrame
    names: tuple
    dataset: str

    @property
    def passed(self) -> DataFrame:
        return self.annotated.where(F.col(REASON).isNull()).drop(REASON, CHECK)

    @property
    def failed(self) -> DataFrame:
        return self.annotated.where(F.col(REASON).isNotNull()).drop(CHECK)

    def _checks(self) -> DataFrame:
        return self.annotated.sparkSession.createDataFrame(list(enumerate(self.names)), f"{CHECK} int, check_name string")

    def reason_counts(self) -> DataFrame:
        """One row per check and distinct reason with its value: (dataset, check_name, failure_reason, records)."""
        counts = self.annotated.where(F.col(REASON).isNotNull()).groupBy(CHECK, REASON).agg(F.count("*").alias("records"))
        return counts.join(self._checks(), CHECK).select(F.lit(self.dataset).alias("dataset"), "check_name", REASON, "records")

    def report(self) -> DataFrame:
        """One row per check: rows seen, passed, quarantined and the distinct reasons joined by commas.

        Reasons are listed without the values they carry, as those grow with the data; ``reason_counts`` has every one.
        """
        checks = self._checks()
        counts = self.annotated.where(F.col(REASON).isNotNull()).groupBy(CHECK, without_value(REASON).alias("_text")).agg(F.count("*").alias("n"))
        reasons = (counts.groupBy(CHECK).agg(F.sum("n").alias("bad"), F.array_join(F.array_sort(F.collect_set("_text")), ", ").alias("failure_reasons")))
        total = self.annotated.agg(F.count("*")).scalar()
        earlier = Window.orderBy(CHECK).rowsBetween(Window.unboundedPreceding, -1)  # one row per check
        bad = F.coalesce(F.col("bad"), F.lit(0))
        return (checks.join(reasons, CHECK, "left")
                .withColumn("records_checked", total - F.coalesce(F.sum(bad).over(earlier), F.lit(0)))
                .select(F.lit(self.dataset).alias("dataset"), "check_name", "records_checked",
                        (F.col("records_checked") - bad).alias("records_passed"), bad.alias("records_quarantined"),
                        F.coalesce("failure_reasons", F.lit("")).alias("failure_reasons")))


def run_checks(df: DataFrame, checks: Sequence[Check], dataset: str) -> CheckRun:
    """Apply the checks in order, each to the survivors of the last."""
    out = df.withColumns({REASON: F.lit(None).cast("string"), CHECK: F.lit(None).cast("int")})
    for i, check in enumerate(checks):
        out = check.reason(out) if callable(check.reason) and not isinstance(check.reason, Column) \
            else out.withColumn("_reason", check.reason)
        fresh = F.col(REASON).isNull() & F.col("_reason").isNotNull()
        out = out.withColumns({CHECK: F.when(fresh, F.lit(i)).otherwise(F.col(CHECK)),
                               REASON: F.coalesce(REASON, "_reason")}).drop("_reason")
    return CheckRun(out, tuple(c.name for c in checks), dataset)


def quarantine_union(frames: Sequence[DataFrame]) -> DataFrame:
    """All failures of a dataset in one table, schemas may differ."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def quarantine_rate(passed: DataFrame, failed: DataFrame, dataset: str, limit_pct: float = 30.0) -> DataFrame:
    """Share of rejected rows in percent and whether it is alarming."""
    both = passed.select(F.lit(0).alias("bad")).unionAll(failed.select(F.lit(1).alias("bad")))
    rate = F.coalesce(F.try_divide("records_quarantined", "records_in") * 100.0, F.lit(0.0))
    return (both.agg(F.count("*").alias("records_in"), F.coalesce(F.sum("bad"), F.lit(0)).alias("records_quarantined"))
            .select(F.lit(dataset).alias("dataset"), "records_in", "records_quarantined",
                    rate.alias("quarantine_pct"), (rate > limit_pct).alias("alarm")))


# --- expectations -----------------------------------------------------------------------------

@dataclass(frozen=True)
class Rule:
    name: str
    violated: Column


def expect(df: DataFrame, rules: Sequence[Rule], unique: Sequence[str] = ()) -> DataFrame:
    """Violations per rule, all row rules in one pass; ``unique`` adds a key rule."""
    aggs = [F.count_if(F.coalesce(r.violated, F.lit(True))).alias(f"r{i}") for i, r in enumerate(rules)]
    rows = F.array(*[F.struct(F.lit(r.name).alias("rule"), F.col(f"r{i}").alias("violations")) for i, r in enumerate(rules)])
    out = df.agg(*aggs).select(F.explode(rows).alias("x")).select("x.*")
    if unique:
        dup = df.groupBy(*unique).agg((F.count("*") - 1).alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("violations"))
        out = out.unionByName(dup.select(F.lit("unique:" + ",".join(unique)).alias("rule"), "violations"))
    return out.withColumn("ok", F.col("violations") == 0)


def not_null(*columns: str) -> list[Rule]:
    return [Rule(f"not_null:{c}", F.col(c).isNull()) for c in columns]


def bounds(column: str, low=None, high=None) -> Rule:
    c = F.col(column)
    bad = F.lit(False)
    if low is not None:
        bad = bad | (c < low)
    if high is not None:
        bad = bad | (c > high)
    return Rule(f"bounds:{column}", bad)


def allowed(column: str, values: Sequence) -> Rule:
    return Rule(f"allowed:{column}", ~F.col(column).isin(*values))


def monotone(*columns: str) -> list[Rule]:
    return [Rule(f"monotone:{a}<={b}", F.col(a) > F.col(b)) for a, b in zip(columns, columns[1:])]


def implies(name: str, premise: Column, conclusion: Column) -> Rule:
    return Rule(f"implies:{name}", premise & ~conclusion)


def same_count(a: DataFrame, b: DataFrame, name: str) -> DataFrame:
    """Row-count reconciliation of two tables as an expectation row."""
    d = F.abs(a.agg(F.count("*")).scalar() - F.col("n"))
    return b.agg(F.count("*").alias("n")).select(F.lit(f"row_count:{name}").alias("rule"), d.alias("violations"), (d == 0).alias("ok"))


class ExpectationError(AssertionError):
    pass


def enforce(expectations: DataFrame) -> None:
    """Raise when a rule is violated (reads one row per rule)."""
    bad = [f"{r.rule}: {r.violations}" for r in expectations.where("not ok").collect()]
    if bad:
        raise ExpectationError("; ".join(bad))


def fail_on_quarantine(run: CheckRun) -> DataFrame:
    """Strict mode: any failed row aborts the dataset."""
    if not run.failed.isEmpty():
        raise ExpectationError(f"{run.dataset}: rows failed in strict mode")
    return run.passed


# --- health ------------------------------------------------------------------------------------

def pipeline_health(dataset: str, passed: DataFrame, rejected: DataFrame, base_check: str) -> DataFrame:
    """Totals of one dataset and its counts per reason, without the values reasons carry, as a JSON array."""
    reasons = rejected.groupBy(without_value(REASON).alias("reason")).agg(F.count("*").alias("n"))
    total_bad = F.coalesce(F.sum("n"), F.lit(0))
    listed = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("neg"), F.col("reason"))))
    good = passed.agg(F.count("*")).scalar()
    out = reasons.agg(total_bad.alias("records_quarantined"), listed.alias("l")).withColumn("records_passed", good)
    total = F.col("records_passed") + F.col("records_quarantined")
    title = lambda r: F.concat(F.lit("Valid "), title_case(F.replace(r, F.lit("_"), F.lit(" "))))
    entries = F.transform("l", lambda x: F.struct(
        title(x.reason).alias("check_name"), (F.col("records_checked") + x.neg).alias("passed"),
        (-x.neg).alias("quarantined"), x.reason.alias("failure_reason")))
    base = F.array(F.struct(F.lit(base_check).alias("check_name"), F.col("records_passed").alias("passed"),
                            F.lit(0).cast("long").alias("quarantined"), F.lit("None").alias("failure_reason")))
    return (out.withColumn("records_checked", total)
            .select(F.lit(dataset).alias("dataset"), "records_checked", "records_passed", "records_quarantined",
                    F.when(total > 0, F.col("records_quarantined") / total).otherwise(F.lit(0.0)).alias("quarantine_rate"),
                    F.to_json(F.concat(entries, base)).alias("check_details_json")))


def health_summary(health: DataFrame, healthy_above: float = 0.99) -> DataFrame:
    checked, passed, bad = F.sum("records_checked"), F.sum("records_passed"), F.sum("records_quarantined")
    share = F.when(F.col("records_checked") > 0, F.col("records_passed") / F.col("records_checked")).otherwise(F.lit(0.0))
    rate = F.when(checked > 0, passed / checked).otherwise(F.lit(0.0))
    return health.agg(checked.alias("total_checked"), passed.alias("total_passed"), bad.alias("total_quarantined"),
                      rate.alias("overall_pass_rate"),
                      F.when(checked > 0, bad / checked).otherwise(F.lit(0.0)).alias("overall_quarantine_rate"),
                      F.coalesce(F.avg(share), F.lit(0.0)).alias("average_dataset_health"),
                      (rate > healthy_above).alias("is_healthy"))
