import pytest
from pyspark.sql import functions as F

from checks.inputs import encounters
from tests.helpers import SF_DIR, column
from wardstat.functions.clinical import (
    ICD9_CIRCULATORY,
    ICD9_DIABETES,
    ICD9_RESPIRATORY,
    age_bounds,
    age_midpoint,
    icd9_number,
    in_ranges,
)
from wardstat.functions.labels import AGE_EDGES_EXPORT, AGE_EDGES_SUMMARY, AGE_LABELS, age_band, cut, map_labels
from wardstat.functions.numbers import round_ratio, safe_ratio
from wardstat.functions.risk import flagged, proba_tier, risk_score, risk_tier
from wardstat.operators.features import cast_counts, engineer_features
from wardstat.sources.encounters import PANDAS_NA_TOKENS, normalise_nulls
from wardstat.sources.schemas import FEATURES


def texts(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")


def test_age_midpoint(spark):
    cases = {
        "[50-60)": 55, "[0-10)": 5, "[90-100)": 95, "50-60": 55, "[70-75)": 72, " [10-20) ": 15, None: 55, "?": 55,
        "unknown": 55, "[50)": 55, "[1-2-3)": 55, "[a-b)": 55, "": 55, "[1.5-3)": 55,
    }
    got = texts(spark, cases).select("v", age_midpoint(age_bounds(F.col("v"))).alias("m"))
    assert column(got, "v", "m") == cases


def test_diagnosis_groups(spark):
    cases = {}
    cases.update(dict.fromkeys(["250", "250.83", "2.5e2"], (1, 0, 0)))
    cases.update(dict.fromkeys(["390", "459.9", "785", "785.9", " 428 ", "\t428\n"], (0, 1, 0)))
    cases.update(dict.fromkeys(["460", "519.9", "786", "786.9"], (0, 0, 1)))
    cases.update(
        dict.fromkeys(
            ["249.99", "251", "520", "787", "V27", "E885", "e885", "250d", "250f", "nan", "inf", "?", None, "", "1e400", "-250"],
            (0, 0, 0),
        )
    )
    code = icd9_number(F.col("v"))
    got = texts(spark, cases).select(
        "v", *[in_ranges(code, r).alias(n) for n, r in [("d", ICD9_DIABETES), ("c", ICD9_CIRCULATORY), ("r", ICD9_RESPIRATORY)]]
    )
    assert {r["v"]: (r["d"], r["c"], r["r"]) for r in got.collect()} == cases


RAW = (
    "encounter_id long, patient_nbr long, gender string, age string, time_in_hospital int, num_lab_procedures int, "
    "num_procedures int, num_medications int, number_outpatient int, number_emergency int, number_inpatient int, "
    "number_diagnoses int, diag_1 string, medical_specialty string, A1Cresult string, insulin string, change string, "
    "diabetesMed string, readmitted string"
)


def row(**changes):
    base = dict(
        encounter_id=1, patient_nbr=1, gender="Male", age="[50-60)", time_in_hospital=1, num_lab_procedures=2,
        num_procedures=3, num_medications=4, number_outpatient=1, number_emergency=2, number_inpatient=3,
        number_diagnoses=5, diag_1="250", medical_specialty="InternalMedicine", A1Cresult="None", insulin="No",
        change="No", diabetesMed="Yes", readmitted="NO",
    )
    return tuple({**base, **changes}.values())


def test_category_rules(spark):
    rows = [
        row(encounter_id=1),
        row(encounter_id=2, A1Cresult="Norm", insulin="Up", change="Ch", readmitted="<30", medical_specialty="INTERNAL-Other"),
        row(encounter_id=3, A1Cresult=">7", insulin="Steady", readmitted=">30", medical_specialty="Cardiology"),
        row(encounter_id=4, A1Cresult=">8", insulin="Down", readmitted="no", gender="Female"),
        row(encounter_id=5, A1Cresult=None, insulin=None, readmitted=None, change=None, diabetesMed=None, gender=None,
            medical_specialty=None),
    ]
    got = {r["encounter_id"]: r for r in engineer_features(spark.createDataFrame(rows, RAW)).collect()}

    def values(name):
        return [got[i][name] for i in range(1, 6)]

    assert values("has_a1c_result") == [0, 1, 1, 1, 1]
    assert values("a1c_high") == [0, 0, 1, 1, 0]
    assert values("on_insulin") == [0, 1, 1, 1, 0]
    assert values("change_meds") == [0, 1, 0, 0, 0]
    assert values("on_diabetes_med") == [1, 1, 1, 1, 0]
    assert values("readmitted_30") == [0, 1, 0, 0, 0]
    assert values("readmitted_any") == [0, 1, 1, 1, 1]
    assert values("gender_enc") == [1, 1, 1, 0, 0]
    assert values("specialty_internal_med") == [1, 1, 0, 1, 0]
    assert values("total_visits") == [6] * 5


def test_pandas_tokens_turn_the_no_test_category_into_unknown(spark):
    df = normalise_nulls(spark.createDataFrame([row()], RAW), PANDAS_NA_TOKENS)
    assert engineer_features(df).first()["has_a1c_result"] == 1


def test_schema_and_no_python(spark):
    features = engineer_features(normalise_nulls(encounters(spark, SF_DIR)))
    assert [(f.name, f.dataType) for f in features.schema] == [(f.name, f.dataType) for f in FEATURES]
    plan = features._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and plan.count("Exchange hashpartitioning") == 1


def test_strict_counts(spark):
    df = spark.createDataFrame([("3",), ("4.9",), ("x",), (None,), ("12d",)], "time_in_hospital string")
    loose = cast_counts(df, ["time_in_hospital"], strict=False)
    assert [r[0] for r in loose.collect()] == [3, 4, None, None, None]
    with pytest.raises(Exception, match="time_in_hospital holds a null"):
        cast_counts(df, ["time_in_hospital"]).collect()
    with pytest.raises(Exception, match="patient_nbr holds a null"):
        engineer_features(spark.createDataFrame([row(patient_nbr=None)], RAW)).collect()


def test_age_bands(spark):
    cases = {
        0: ("0-30", None, None), 30: ("0-30",) * 3, 31: ("31-50",) * 3, 50: ("31-50",) * 3, 70: ("51-70",) * 3,
        71: ("71+",) * 3, 111: ("71+", None, "71+"), 121: ("71+", None, None), -1: ("71+", None, None),
        None: ("71+", None, None),
    }
    a = F.col("a")
    got = spark.createDataFrame([(k,) for k in cases], "a int").select(
        a, age_band(a).alias("x"), cut(a, AGE_EDGES_SUMMARY, AGE_LABELS).alias("y"), cut(a, AGE_EDGES_EXPORT, AGE_LABELS).alias("z")
    )
    assert {r["a"]: (r["x"], r["y"], r["z"]) for r in got.collect()} == cases


def test_map_labels(spark):
    got = spark.createDataFrame([(0,), (1,), (2,), (None,)], "a int").select(map_labels(F.col("a"), {0: "n", 1: "y"}).alias("l"))
    assert [r["l"] for r in got.collect()] == ["n", "y", None, None]


def test_risk_points(spark):
    cases = [
        ((5, 20, 1, 7), 8, "High Risk"), ((5, 15, 0, 7), 5, "High Risk"), ((3, 20, 0, 0), 4, "Medium Risk"),
        ((5, 0, 0, 0), 3, "Medium Risk"), ((4, 15, 0, 0), 2, "Low Risk"), ((2, 14, 1, 6), 1, "Low Risk"),
        ((None, 20, 0, 0), 3, "Medium Risk"),
    ]
    df = spark.createDataFrame(
        [(i, *values) for i, (values, _, _) in enumerate(cases)],
        "i int, total_visits int, num_medications int, a1c_high int, time_in_hospital int",
    )
    got = df.select("i", risk_score().alias("s"), risk_tier().alias("t")).orderBy("i").collect()
    assert [(r["s"], r["t"]) for r in got] == [(s, t) for _, s, t in cases]


def test_probability_tier(spark):
    cases = {0.5: (True, "HIGH"), 0.49996: (False, "MEDIUM"), 0.3: (False, "MEDIUM"), 0.29999: (False, "LOW")}
    p = F.col("p")
    got = spark.createDataFrame([(k,) for k in cases], "p double").select(p, flagged(p).alias("f"), proba_tier(p).alias("t"))
    assert {r["p"]: (r["f"], r["t"]) for r in got.collect()} == cases


def test_rounding_is_exact_half_up(spark):
    from decimal import ROUND_HALF_UP, Decimal

    pairs = [(s, n) for n in range(1, 120) for s in range(0, n + 1, 3)] + [(-1, 8), (10**12 + 1, 3), (1, 0)]
    df = spark.createDataFrame(pairs, "s long, n long")
    got = df.select("s", "n", round_ratio(F.col("s"), F.col("n"), 2, scale=100).alias("r")).collect()
    for r in got:
        if r["n"] == 0:
            assert r["r"] is None
        else:
            exact = (Decimal(100 * r["s"]) / Decimal(r["n"])).quantize(Decimal("0.01"), ROUND_HALF_UP)
            assert r["r"] == float(exact)
    assert df.select(safe_ratio(F.lit(1), F.lit(0)).alias("x")).first()["x"] is None


def test_rules_are_compiled_in_sessions_of_others(spark):
    """A session without a limit gets one, so that the rules' stage is not interpreted; a limit that is set stays."""
    name = "spark.sql.codegen.hugeMethodLimit"
    own = spark.conf.get(name)
    try:
        spark.conf.unset(name)
        engineer_features(encounters(spark, SF_DIR))
        assert spark.conf.get(name) == "8000"
        spark.conf.set(name, "9000")
        engineer_features(encounters(spark, SF_DIR))
        assert spark.conf.get(name) == "9000"
    finally:
        spark.conf.set(name, own)
