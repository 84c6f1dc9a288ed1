import pytest
from conftest import rows
from pyspark.sql import functions as F

from retailpot.operators import quality as q


@pytest.fixture(scope="module")
def people(spark):
    data = [(1, "a", 1.0), (2, "a", 1.0), (3, None, 2.0), (4, None, 2.0), (5, "b", None), (6, " ", 3.0), (7, "B", 0.0)]
    return spark.createDataFrame(data, "id int, k string, v double")


def reasons(df, *checks):
    run = q.run_checks(df, checks, "d")
    return {r.id: r[q.REASON] for r in run.annotated.collect()}


def test_duplicate_keeps_first_last_or_none(people):
    dup = "duplicate_record"
    first = reasons(people, q.duplicate_check(["k", "v"], "id"))
    assert [i for i, r in first.items() if r == dup] and {i for i, r in first.items() if r == dup} == {2, 4}
    assert {i for i, r in reasons(people, q.duplicate_check(["k", "v"], "id", keep="last")).items() if r} == {1, 3}
    assert {i for i, r in reasons(people, q.duplicate_check(["k", "v"], "id", keep=False)).items() if r} == {1, 2, 3, 4}
    with pytest.raises(ValueError):
        q.run_checks(people, [q.duplicate_check(["nope"], "id")], "d")


def test_duplicate_on_a_hot_key_spreads_and_keeps_one(spark):
    df = spark.range(5000).select("id", F.when(F.col("id") % 3 > 0, F.lit(7)).otherwise(F.col("id")).alias("k"))
    run = q.run_checks(df, [q.duplicate_check(["k"], "id", salts=16)], "d")
    want = df.groupBy("k").agg(F.min("id").alias("id"))
    assert rows(run.passed, "id") == rows(want, "id")
    one = q.run_checks(df, [q.duplicate_check(["k"], "id", keep=False, salts=16)], "d")
    assert rows(one.passed, "k") == rows(df.groupBy("k").count().where("count = 1"), "k")


def test_duplicate_ignores_rows_that_failed_before(people):
    got = reasons(people, q.condition_check("x", F.col("id") == 1, "first_is_bad"), q.duplicate_check(["k", "v"], "id"))
    assert got[1] == "first_is_bad" and got[2] is None


def test_null_and_blank(people):
    got = reasons(people, q.null_check(["k", "v"]))
    assert got[3] == "null_in_mandatory_field:k" and got[5] == "null_in_mandatory_field:v" and got[6] == "null_in_mandatory_field:k" and got[7] is None
    assert not any(reasons(people, q.null_check([])).values())


def test_reference(spark, people):
    ref = spark.createDataFrame([("a",), ("a",), (None,)], "x string")
    got = reasons(people, q.ref_integrity_check("k", ref, "x"))
    assert got[1] is None and got[3] == "null_foreign_key:k" and got[7] == "referential_integrity_violation:k"


@pytest.mark.parametrize("inclusive,bad", [(True, {5, 6}), (False, {1, 2, 5, 6, 7})])
def test_range_bounds(people, inclusive, bad):
    got = reasons(people, q.range_check("v", 0, 2.5, inclusive) if inclusive else q.range_check("v", 0, 3, inclusive))
    if not inclusive:
        assert {i for i, r in got.items() if r} == {5, 6, 7}
    else:
        assert {i for i, r in got.items() if r} == bad
    assert got[5] == "null_in_range_col:v" and got[6] == "out_of_range:v:value=3.0"
    assert not any(reasons(people, q.range_check("v")).values())


def test_format_is_full_match(spark):
    df = spark.createDataFrame([(1, "OUT_00001"), (2, "xOUT_00001"), (3, "OUT_000012"), (4, None), (5, "OUT_00001\n")], "id int, c string")
    got = reasons(df, q.format_check("c", r"OUT_\d{5}"))
    assert got[1] is None and got[4] == "null_in_format_col:c" and all(got[i].startswith("format_violation:c") for i in (2, 3, 5))


def test_value_set(people):
    assert {i for i, r in reasons(people, q.value_set_check("k", ["a", "b"])).items() if r} == {3, 4, 6, 7}
    loose = reasons(people, q.value_set_check("k", ["A", "b"], case_sensitive=False))
    assert {i for i, r in loose.items() if r} == {3, 4, 6} and loose[3] == "invalid_value:k:found=None"


def test_run_is_sequential_and_reconciles(people):
    run = q.run_checks(people, [q.duplicate_check(["k", "v"], "id"), q.null_check(["k", "v"]), q.range_check("v", 0.5)], "people")
    assert run.passed.count() + run.failed.count() == 7
    rep = {r.check_name: r for r in run.report().collect()}
    assert (rep["duplicate_check"].records_checked, rep["null_check"].records_checked, rep["range_check"].records_checked) == (7, 5, 2)
    assert rep["null_check"].failure_reasons == "null_in_mandatory_field:k, null_in_mandatory_field:v"
    assert rep["range_check"].failure_reasons == "out_of_range:v"  # values are rows of their own
    detail = run.reason_counts().collect()
    assert sum(r.records for r in detail) == run.failed.count() and any(r.failure_reason.startswith("out_of_range:v:value=") for r in detail)


def test_empty_and_all_failing(people):
    none = q.run_checks(people.where("id < 0"), [q.null_check(["k"])], "d")
    assert none.passed.count() == 0 and none.report().collect()[0].records_checked == 0
    every = q.run_checks(people, [q.range_check("id", 100)], "d")
    assert every.passed.count() == 0 and every.failed.count() == 7
    with pytest.raises(q.ExpectationError):
        q.fail_on_quarantine(every)


def test_expectations_and_rates(spark, people):
    e = {r.rule: r.violations for r in q.expect(people, [*q.not_null("k"), q.bounds("v", 0, 2), q.allowed("id", range(1, 7))], unique=["k"]).collect()}
    assert e == {"not_null:k": 2, "bounds:v": 2, "allowed:id": 1, "unique:k": 2}
    with pytest.raises(q.ExpectationError):
        q.enforce(q.expect(people, q.not_null("k")))
    q.enforce(q.expect(people, q.not_null("id"), unique=["id"]))
    rate = q.quarantine_rate(people.where("id < 5"), people.where("id >= 5"), "d").first()
    assert rate.records_in == 7 and rate.alarm
    u = q.quarantine_union([people.select("id"), people.select("k")])
    assert u.count() == 14 and u.columns == ["id", "k"]


def test_health_cuts_values_and_titles(spark):
    bad = spark.createDataFrame([("out_of_range:v:value=1.0",), ("out_of_range:v:value=2.0",), ("duplicate_record",)], "failure_reason string")
    h = q.pipeline_health("d", spark.range(97), bad, "Base").first()
    assert (h.records_checked, h.records_passed, h.records_quarantined) == (100, 97, 3)
    assert h.check_details_json.startswith('[{"check_name":"Valid Out Of Range:V","passed":98,"quarantined":2,"failure_reason":"out_of_range:v"}')
    many = q.pipeline_health("d", spark.range(1), spark.range(5).selectExpr("concat('invalid_value:c:found=', id) AS failure_reason"), "Base").first()
    assert '"quarantined":5,"failure_reason":"invalid_value:c"' in many.check_details_json
    s = q.health_summary(spark.createDataFrame([("d", 100, 97, 3), ("e", 0, 0, 0)], "dataset string, records_checked long, records_passed long, records_quarantined long")).first()
    assert s.overall_pass_rate == 0.97 and s.average_dataset_health == pytest.approx(0.485) and not s.is_healthy
