"""Places of deleted rows where the files of several slices have one name."""

from pyspark.sql import functions as F

from mastermill import ENTITIES, open_store
from mastermill.sources.tables import FILE, SEGMENT

BOM = ENTITIES["bill_of_materials"]


def test_a_deleted_place_is_one_of_its_slice(spark, tmp_path):
    """Before, the rows at the same place of the other slices that one task wrote were lost to readers as well."""
    store = open_store(spark, str(tmp_path / "s"), BOM)
    data = spark.range(100).select(F.col("id").cast("string").alias("assemb"), F.lit("C").alias("compnt")).coalesce(1)
    units = store.write_segment("target", slices=4, placed=[data])
    first = store.commit("a", {"target": units}, None)
    places = store.rows("target", first, places=True).filter("assemb = '7'").cache()
    assert store.rows("target", first, places=True).select(FILE).distinct().count() == 1 and len(units) == 4
    deletes = store.write_deletes("target", places, 1, first, units)
    head = store.commit("b", {"target": units}, first, deletes={"target": deletes})
    left = {r.assemb for r in store.read("target", head).collect()}
    assert left == {str(n) for n in range(100)} - {"7"}
    assert store.rows("target", head, [places.first()[SEGMENT]]).filter("assemb = '7'").count() == 0
