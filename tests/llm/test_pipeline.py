from collections import Counter

import corpus_pipeline
from pyspark.sql import functions as F

from tests.llm.helpers import SF, pairs_of
from tests.llm.test_decontamination import plain as leaks
from tests.llm.test_simhash import components, fingerprint
from wardstat.llm import byte_bpe
from wardstat.llm.common import stored, table
from wardstat.llm.queries import QUERIES


def test_stages_one_by_one(spark):
    docs = table(spark, SF, "documents")
    columns = docs.columns
    labels = {r["doc_id"]: r["toxic"] for r in table(spark, SF, "labels").collect()}
    stages = dict(corpus_pipeline.STAGES)

    kept = stored(stages["toxicity"](spark, docs, SF), "t1")
    assert kept.columns == columns
    gone = {k for k, _ in pairs_of(docs)} - {k for k, _ in pairs_of(kept)}
    assert all(labels.get(k) != 0 for k in gone)

    lined = stored(stages["line_dedup"](spark, kept, SF), "t2")
    assert lined.columns == columns and lined.count() == kept.count()
    assert lined.where(F.col("n_chars") != F.length("text")).count() == kept.where(F.col("n_chars") != F.length("text")).count()

    single = stored(stages["simhash_near_dedup"](spark, lined, SF), "t3")
    rows = pairs_of(lined)
    least = components([(k, fingerprint(t)) for k, t in rows])
    assert single.columns == columns
    assert sorted(k for k, _ in pairs_of(single)) == sorted(set(least.values()))

    clean = stored(stages["benchmark_decontamination"](spark, single, SF), "t4")
    items = [(r["item_id"], r["text"]) for r in table(spark, SF, "benchmark").collect()]
    bad = {k for k, _, _ in leaks(pairs_of(single), items)}
    assert clean.columns == columns and Counter(pairs_of(clean)) == Counter(p for p in pairs_of(single) if p[0] not in bad)

    coded = stages["byte_bpe"](spark, clean, SF)
    assert sorted(r["doc_id"] for r in coded.collect()) == sorted(k for k, _ in pairs_of(clean))


def test_pipeline_survives_empty_and_odd_documents(spark, docs, empty, tmp_path):
    for name, rows in (("odd", docs), ("none", empty)):
        folder = f"{tmp_path}/{name}"
        rows.select("doc_id", "text", F.lit("en").alias("lang"), "key", F.length("text").cast("long").alias("n_chars"), "_row", "_text", F.col("h").alias("_Dropped"), F.col("h").alias("_toxic")).write.parquet(f"{folder}/documents.parquet")
        for other in ("labels", "benchmark"):
            table(spark, SF, other).write.parquet(f"{folder}/{other}.parquet")
        found = corpus_pipeline.run(spark, folder)
        assert (found.count() > 10) == (name == "odd")


def test_entry_registers_all_queries():
    import __spark_entry__

    names = set(__spark_entry__.queries())
    assert set(QUERIES) < names and "pipeline" in names
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert byte_bpe.WIDTHS == tuple(sorted(byte_bpe.WIDTHS))
