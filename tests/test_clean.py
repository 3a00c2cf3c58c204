from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from landfall.operators.clean import REQUIRED, clean_arrivals, null_audit

SCHEMA = "arrdate double, depdate double, i94mode double, i94visa double, biryear double, gender string"
FULL = (20545.0, 20550.0, 1.0, 2.0, 1980.0, "F")


def without(*columns):
    return tuple(None if name in columns else value for name, value in zip(REQUIRED, FULL))


def test_audit_charges_the_first_null(spark):
    rows = [FULL, FULL, (0.0, *FULL[1:]), (FULL[0], float("nan"), *FULL[2:])]
    rows += [without(c) for c in REQUIRED]
    rows += [without("depdate", "gender"), without(*REQUIRED)]
    df = spark.createDataFrame(rows, SCHEMA)
    audit = null_audit(df).first().asDict()
    assert audit == {
        "total_rows": 12, "removed_arrdate": 2, "removed_depdate": 2, "removed_i94mode": 1,
        "removed_i94visa": 1, "removed_biryear": 1, "removed_gender": 1, "kept_rows": 4,
        "undated_arrdate": 1, "undated_depdate": 1, "balanced": True,
    }
    assert clean_arrivals(df).count() == 4


def test_nan_is_a_value(spark):
    df = spark.createDataFrame([(*FULL[:2], float("nan"), *FULL[3:])], SCHEMA)
    assert clean_arrivals(df).count() == 1


def test_audit_of_no_rows(spark):
    audit = null_audit(spark.createDataFrame([], SCHEMA)).first()
    assert audit["total_rows"] == 0 and audit["balanced"]


maybe = st.one_of(st.none(), st.floats(-1e6, 1e6))


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(maybe, maybe, maybe, maybe, maybe, st.sampled_from([None, "F", "M"])), max_size=40))
def test_audit_adds_up(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    audit = null_audit(df).first()
    assert audit["balanced"]
    assert audit["total_rows"] == len(rows)
    assert audit["kept_rows"] == sum(None not in r for r in rows) == clean_arrivals(df).count()
