"""Slices of few rows get no more files than they need."""

from pyspark.sql import functions as F

from mastermill import ENTITIES, RunOptions, open_store, run_entity

BOM = ENTITIES["bill_of_materials"]


def test_small_slices_get_one_file_each(spark, tmp_path):
    """Before, each of the staged files wrote its own file to every slice whose rows it held, up to 16 small ones for a slice."""
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(setting, "false")  # four staged files
    try:
        store = open_store(spark, str(tmp_path / "s"), BOM, unit_rows=50, rewrite_rows=0)
        data = spark.range(500).select(F.concat(F.lit("A"), "id").alias("ASSEMB"), F.lit("C").alias("COMPNT"), F.lit("n").alias("NAME"))
        assert run_entity(store, BOM, data, RunOptions()).data_insert_count == 500
        units = store.head().units["target"]
        assert len(units) == 10 and sum(u.rows for u in units.values()) == 500
        for table in ("target", "state"):
            assert len(store.read_segments(table, units).inputFiles()) == 10
        assert sorted(r.id for r in store.read("target").select("id").collect()) == list(range(1, 501))
    finally:
        spark.conf.unset(setting)
