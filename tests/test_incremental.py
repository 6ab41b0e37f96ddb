"""States that follow their input."""

import itertools

import pytest
from pyspark.sql import functions as F

from checks.inputs import encounters
from tests.helpers import SF_DIR
from wardstat.operators.cohort import build_cohort
from wardstat.operators.segments import segment_kpis
from wardstat.plans.incremental import kpis_by_part, merge_encounters, merged_cohort, refresh_kpis_by_part
from wardstat.sources import manifest
from wardstat.sources.encounters import normalise_nulls
from wardstat.sources.tables import write_table


def rows_of(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("raw") / "t")
    encounters(spark, SF_DIR).where("patient_nbr < 60").write.parquet(path)
    return spark.read.parquet(path)


def test_cohort_for_any_order_of_arrival(spark, raw, tmp_path):
    want = rows_of(build_cohort(raw))
    loads = [raw.where(f"encounter_id % 3 = {i}") for i in range(3)]
    for n, order in enumerate(itertools.permutations(range(3))):
        path = f"{tmp_path}/{n}"
        for i in order:
            merge_encounters(loads[i], path)
        assert rows_of(merged_cohort(spark, path, normalise_nulls(raw).schema)) == want


def test_rows_that_come_again_change_nothing_and_few_parts_are_rewritten(spark, raw, tmp_path):
    path = str(tmp_path)
    merge_encounters(raw, path)
    before = manifest.visible(spark, path)
    one = raw.where("gender = 'Female'").limit(1)
    (part,) = merge_encounters(one, path)
    after = manifest.visible(spark, path)
    assert {name for name in after if after[name] != before.get(name)} == {part}
    assert rows_of(merged_cohort(spark, path, normalise_nulls(raw).schema)) == rows_of(build_cohort(raw))
    assert merge_encounters(raw.where("gender = 'Unknown/Invalid'"), path) == []


def test_kpis_read_only_what_changed(spark, features, tmp_path):
    parts = {f"p{i}": f"{tmp_path}/p{i}" for i in range(3)}
    for i, folder in enumerate(parts.values()):
        write_table(features.where(F.col("encounter_id") % 3 == i), folder)
    path = f"{tmp_path}/sums"
    two = {k: parts[k] for k in ("p0", "p1")}
    assert refresh_kpis_by_part(spark, two, path) == ["p0", "p1"]
    assert refresh_kpis_by_part(spark, parts, path) == ["p2"]
    assert rows_of(kpis_by_part(spark, path)) == rows_of(segment_kpis(features))
    write_table(features.where("encounter_id % 3 = 0 and age_mid > 50"), parts["p0"])
    assert refresh_kpis_by_part(spark, parts, path) == ["p0"]
    assert rows_of(kpis_by_part(spark, path)) == rows_of(segment_kpis(features.where("encounter_id % 3 > 0 or age_mid > 50")))
    assert refresh_kpis_by_part(spark, two, path) == []
    assert rows_of(kpis_by_part(spark, path)) == rows_of(segment_kpis(features.where("encounter_id % 3 = 1 or encounter_id % 3 = 0 and age_mid > 50")))
    # Old parts are not read: their files may be gone from the table of sums' view.
    plan = kpis_by_part(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert str(tmp_path / "p0") not in plan and str(tmp_path / "p1") not in plan


def test_a_writer_that_dies_leaves_the_old_part(spark, tmp_path):
    path = str(tmp_path)
    manifest.publish(spark, path, {"a": spark.range(3), "b": spark.range(5)})
    broken = spark.range(0, 10, 1, 4).select(F.when(F.col("id") == 9, F.raise_error(F.lit("killed"))).otherwise(F.col("id")).cast("long").alias("id"))
    with pytest.raises(Exception, match="killed"):
        manifest.publish(spark, path, {"a": broken, "c": spark.range(2)})
    assert manifest.read_visible(spark, path, "id long").count() == 8
    # A manifest that was cut off does not count, and the next one comes after it.
    number = max(int(p.stem) for p in (tmp_path / "_manifest").glob("*.json"))
    (tmp_path / "_manifest" / f"{number + 1:09d}.json").write_text('{"a": "par')
    assert manifest.read_visible(spark, path, "id long").count() == 8
    manifest.publish(spark, path, {"c": spark.range(2)}, removed=("b",))
    assert set(manifest.visible(spark, path)) == {"a", "c"} and manifest.read_visible(spark, path, "id long", ["c"]).count() == 2
    manifest.vacuum(spark, path)
    assert len(list(tmp_path.glob("part-*"))) == 2 and manifest.read_visible(spark, path, "id long").count() == 5


def test_nothing_published_gives_no_rows(spark, tmp_path):
    assert manifest.visible(spark, str(tmp_path / "none")) == {}
    assert manifest.read_visible(spark, str(tmp_path / "none"), "id long").count() == 0
    manifest.publish(spark, str(tmp_path / "none"), {})
    assert not (tmp_path / "none").exists()
