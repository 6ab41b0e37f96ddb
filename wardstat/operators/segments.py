"""Rates by segment and KPI tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardstat.functions.labels import AGE_EDGES_EXPORT, AGE_LABELS, age_band, cut, map_labels
from wardstat.functions.numbers import round_ratio, safe_ratio
from wardstat.functions.risk import risk_tier
from wardstat.sources.schemas import TARGET


def _rows() -> Column:
    return F.count(F.lit(1))


def mean_of(name: str, digits: int = 2) -> Column:
    """Rounded mean of a whole-number column over its known values."""
    return round_ratio(F.sum(name), F.count(name), digits)


def overall_rates(features: DataFrame) -> DataFrame:
    """Row count, both return counts and both rates in percent; one row, also for no input."""
    return features.agg(
        _rows().alias("total_encounters"),
        F.sum("readmitted_30").alias("readmitted_under_30"),
        round_ratio(F.sum("readmitted_30"), _rows(), 2, scale=100).alias("readmission_rate_30_pct"),
        F.sum("readmitted_any").alias("readmitted_any"),
        round_ratio(F.sum("readmitted_any"), _rows(), 2, scale=100).alias("readmission_rate_any_pct"),
    )


def rate_by(
    features: DataFrame,
    keys: Mapping[str, Column] | Sequence[str],
    total: str = "encounters",
    positives: str | None = None,
    rate: str = "readmission_rate_pct",
    averages: Mapping[str, str] | None = None,
    target: str = TARGET,
) -> DataFrame:
    """Count, rate in percent and means per key; one pass with partial sums in the map tasks."""
    named = keys if isinstance(keys, Mapping) else {name: F.col(name) for name in keys}
    measures = [_rows().alias(total)]
    if positives:
        measures.append(F.sum(target).alias(positives))
    measures.append(round_ratio(F.sum(target), _rows(), 2, scale=100).alias(rate))
    measures += [mean_of(col).alias(name) for name, col in (averages or {}).items()]
    return features.groupBy(*[col.alias(name) for name, col in named.items()]).agg(*measures)


def rate_by_age(features: DataFrame) -> DataFrame:
    """Rate, length of stay and medications per age band, in band order."""
    return rate_by(
        features,
        {"age_group": age_band(F.col("age_mid"))},
        total="total",
        positives="readmitted_30",
        rate="rate_pct",
        averages={"avg_los": "time_in_hospital", "avg_medications": "num_medications"},
    ).orderBy("age_group")


def rate_by_insulin(features: DataFrame) -> DataFrame:
    """Rate by insulin use and medication change."""
    keys = ["on_insulin", "change_meds"]
    return rate_by(features, keys, positives="readmitted_30", averages={"avg_los": "time_in_hospital"}).orderBy(keys)


def rate_by_a1c(features: DataFrame) -> DataFrame:
    """Rate by whether A1C was tested and high."""
    keys = ["has_a1c_result", "a1c_high"]
    return rate_by(
        features, keys, rate="readmission_rate_30_pct", averages={"avg_medications": "num_medications"}
    ).orderBy(keys)


def rate_by_diagnosis(features: DataFrame) -> DataFrame:
    """Rate by primary diagnosis group, highest first; equal rates in key order."""
    keys = ["diag_diabetes", "diag_circulatory", "diag_respiratory"]
    return rate_by(
        features, keys, rate="readmission_rate_30_pct", averages={"avg_los": "time_in_hospital"}
    ).orderBy(F.desc("readmission_rate_30_pct"), *keys)


def high_risk_profile(features: DataFrame, k: int = 100) -> DataFrame:
    """The ``k`` encounters with most visits, then most medications, among the frequent and medicated."""
    return (
        features.filter((F.col("total_visits") >= 5) & (F.col("num_medications") >= 15))
        .select(
            "encounter_id", "patient_nbr", "age_mid", "time_in_hospital", "num_medications", "total_visits",
            "on_insulin", "a1c_high", "readmitted_30",
        )
        .orderBy(F.desc("total_visits"), F.desc("num_medications"), "encounter_id")
        .limit(k)
    )


def prediction_accuracy(preds: DataFrame) -> DataFrame:
    """Logged predictions per model and run: count, hits, accuracy in percent, mean probability."""
    hit = F.when(F.col("predicted_label") == F.col("actual_label"), 1).otherwise(0)
    return (
        preds.groupBy("model_name", "run_timestamp")
        .agg(
            _rows().alias("predictions_made"),
            F.sum(hit).alias("correct"),
            round_ratio(F.sum(hit), _rows(), 2, scale=100).alias("accuracy_pct"),
            F.round(F.avg("predicted_proba"), 4).alias("avg_predicted_proba"),
        )
        .orderBy(F.desc("run_timestamp"), "model_name")
    )


@dataclass(frozen=True)
class Segments:
    """Which segments a KPI table has.

    ``families`` gives, per segment type in output order, the label expressions of a row; a null
    label means the row is not in that segment. ``always`` lists (type, value) pairs that show even
    when empty, and ``empty_sum`` is what an empty segment's positive count shows.
    """

    families: Sequence[tuple[str, Column]]
    always: Sequence[tuple[str, str]] = field(default_factory=list)
    empty_sum: int | None = None


def sql_segments() -> Segments:
    """Segments of the KPI table that the analysis script fills."""
    insulin = F.when(F.col("on_insulin") == 1, "On Insulin").otherwise("Not on Insulin")
    return Segments(
        families=[
            ("overall", F.lit("All Patients")),
            ("age_group", age_band(F.col("age_mid"))),
            ("insulin", insulin),
        ],
        always=[("overall", "All Patients")],
    )


def export_segments() -> Segments:
    """Segments of the dashboard export."""
    diagnoses = {
        "diag_diabetes": "Primary Dx: Diabetes",
        "diag_circulatory": "Primary Dx: Circulatory",
        "diag_respiratory": "Primary Dx: Respiratory",
    }
    return Segments(
        families=[
            ("overall", F.lit("All Patients")),
            ("age_group", cut(F.col("age_mid"), AGE_EDGES_EXPORT, AGE_LABELS)),
            ("insulin", map_labels(F.col("on_insulin"), {0: "No Insulin", 1: "On Insulin"})),
            *[("diagnosis", F.when(F.col(name) == 1, label)) for name, label in diagnoses.items()],
        ],
        always=[
            ("overall", "All Patients"),
            ("insulin", "No Insulin"),
            ("insulin", "On Insulin"),
            *[("diagnosis", label) for label in diagnoses.values()],
        ],
        empty_sum=0,
    )


def named_segments(kind: str) -> Segments:
    """The segments of the KPI table of the analysis (``sql``) or of the dashboard (``export``)."""
    return {"sql": sql_segments, "export": export_segments}[kind]()


_MEASURES = ("readmitted_30", "time_in_hospital", "num_medications", "total_visits")


def label_sums(features: DataFrame, segments: Segments) -> DataFrame:
    """Rows, sums and counts per combination of labels: at most a few hundred rows, whatever the input's size.

    Sums of two tables that are added up per combination are the sums of both together.
    """
    labels = [col.alias(f"_label_{i}") for i, (_, col) in enumerate(segments.families)]
    return features.groupBy(*labels).agg(
        _rows().alias("n"),
        *[F.sum(name).alias(f"sum_{name}") for name in _MEASURES],
        *[F.count(name).alias(f"n_{name}") for name in _MEASURES],
    )


def segment_kpis(features: DataFrame, segments: Segments | str = "sql") -> DataFrame:
    """One KPI row per segment, from one scan.

    Rows are first summed per combination of labels, so the shuffle is tiny whatever the input size; the combinations
    are then dealt out to the segments they belong to.
    """
    if isinstance(segments, str):
        segments = named_segments(segments)
    return kpis_of_sums(label_sums(features, segments), segments)


def kpis_of_sums(cells: DataFrame, segments: Segments) -> DataFrame:
    """One KPI row per segment, from sums per combination of labels; combinations may come more than once."""
    carried = [name for name in cells.columns if not name.startswith("_label_")]
    memberships = F.array(
        *[
            F.struct(F.lit(kind).alias("segment_type"), F.col(f"_label_{i}").alias("segment_value"))
            for i, (kind, _) in enumerate(segments.families)
        ]
    )
    dealt = cells.select(F.inline(memberships), *carried).filter(F.col("segment_value").isNotNull())
    if segments.always:
        pairs = F.array(
            *[
                F.struct(F.lit(kind).alias("segment_type"), F.lit(value).alias("segment_value"))
                for kind, value in segments.always
            ]
        )
        shown = cells.sparkSession.range(0, 1, 1, 1).select(
            F.inline(pairs), *[F.lit(0 if name.startswith("n") else None).cast("bigint").alias(name) for name in carried]
        )
        dealt = dealt.unionByName(shown)
    totals = dealt.groupBy("segment_type", "segment_value").agg(*[F.sum(name).alias(name) for name in carried])
    positives = F.col("sum_readmitted_30")
    if segments.empty_sum is not None:
        positives = F.coalesce(positives, F.lit(segments.empty_sum).cast("bigint"))
    return totals.select(
        "segment_type",
        "segment_value",
        F.col("n").alias("total_encounters"),
        positives.alias("readmitted_30_count"),
        round_ratio(F.col("sum_readmitted_30"), F.col("n"), 4).alias("readmission_rate_30"),
        *[
            round_ratio(F.col(f"sum_{name}"), F.col(f"n_{name}"), 2).alias(f"avg_{name}")
            for name in _MEASURES[1:]
        ],
    )


def with_kpi_id(kpis: DataFrame, types: Sequence[str] = ("overall", "age_group", "insulin", "diagnosis")) -> DataFrame:
    """KPI rows numbered from 1, by segment type in the given order and then by value.

    The window has no partition key; its input is a KPI table, a dozen rows at most.
    """
    place = F.array_position(F.array(*[F.lit(kind) for kind in types]), F.col("segment_type"))
    numbered = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(place, "segment_value"))
    return kpis.select(numbered.alias("kpi_id"), *kpis.columns)


def insulin_effect(features: DataFrame) -> DataFrame:
    """Rate in percent and row count by insulin use, labelled."""
    return features.groupBy("on_insulin").agg(
        map_labels(F.col("on_insulin"), {0: "Not on Insulin", 1: "On Insulin"}).alias("label"),
        (safe_ratio(F.sum(TARGET), F.count(TARGET)) * 100).alias("rate"),
        F.count(TARGET).alias("total"),
    )


def risk_tier_distribution(features: DataFrame) -> DataFrame:
    """Encounters and rate per risk tier."""
    return rate_by(features, {"risk_tier": risk_tier()}, positives="readmitted_30")


def overview_kpis(features: DataFrame) -> DataFrame:
    """The headline card: encounters, rate, length of stay, share with an A1C test."""
    return features.agg(
        _rows().alias("total_encounters"),
        round_ratio(F.sum(TARGET), _rows(), 2, scale=100).alias("readmission_rate_30_pct"),
        mean_of("time_in_hospital").alias("avg_los"),
        round_ratio(F.sum("has_a1c_result"), _rows(), 2, scale=100).alias("a1c_coverage_pct"),
    )
