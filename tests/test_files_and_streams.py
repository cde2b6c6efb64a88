"""File selection, the day's run, and incremental ingest, on real files."""

import gzip
from dataclasses import replace
from datetime import date

import pytest

from mastermill import ENTITIES, RunOptions, open_store, run_day
from mastermill.plans.entity import AUDIT
from mastermill.sources import append_table, discover_files, is_empty, read_extract, read_table, replace_table, require_accepted
from mastermill.streaming import ingest_stream, stream_rows
from tests.conftest import rows

SUPPLIER = ENTITIES["supplier"]
CSV = "VACODE,VANAME\nS1,one\nS2,\"two, quoted\"\n"


def put(folder, name, text):
    folder.mkdir(parents=True, exist_ok=True)
    if name.endswith(".gz"):
        (folder / name).write_bytes(gzip.compress(text.encode()))
    else:
        (folder / name).write_text(text)


@pytest.fixture
def landing(tmp_path):
    root = tmp_path / "in"
    put(root / "AUS", "AUSSUPPLR_2024_20240508.csv", CSV)
    put(root / "AUS", "AUSSUPPLR_2024_20240507.csv", CSV)
    put(root / "AUS", "AUSFRAN_2024_20240508.csv", CSV)
    return root


DAY = date(2024, 5, 8)


def test_discover_by_prefix_and_day(spark, landing):
    put(landing / "AUS", "AUSSUPPLR_2024_20240508.csv.pgp", "secret")
    found = discover_files(spark, str(landing), SUPPLIER.files, DAY)
    assert rows(found, "file_name", "region", "accepted") == [
        ("AUSSUPPLR_2024_20240508.csv", "AUS", True),
        ("AUSSUPPLR_2024_20240508.csv.pgp", "AUS", False),
    ]
    with pytest.raises(ValueError, match="pgp"):
        require_accepted(found)


def test_read_extract_plain_and_gzip(spark, landing):
    put(landing / "AUS", "z.csv.gz", CSV)
    for name in ("AUSSUPPLR_2024_20240508.csv", "z.csv.gz"):
        df = read_extract(spark, str(landing / "AUS" / name))
        assert dict(df.dtypes) == {"VACODE": "string", "VANAME": "string"}
        assert rows(df) == [("S1", "one"), ("S2", "two, quoted")]
    put(landing / "AUS", "header.csv", "VACODE,VANAME\n")
    put(landing / "AUS", "void.csv", "")
    assert is_empty(read_extract(spark, str(landing / "AUS" / "header.csv")))
    assert is_empty(read_extract(spark, str(landing / "AUS" / "void.csv")))


def test_run_day(spark, landing, tmp_path, run_ts):
    put(landing / "AUS", "AUSSUPPLR_2024_x_20240508.txt", CSV)
    put(landing / "AUS", "AUSSUPPLR_2024_y_20240508.csv", "OTHER\n1\n")
    put(landing / "AUS", "AUSSUPPLR_2024_z_20240508.csv.gz", "vaname,VACODE\nthree,S3\n")
    store = open_store(spark, str(tmp_path / "store"), SUPPLIER)
    records = run_day(store, SUPPLIER, str(landing), DAY, RunOptions(run_ts=run_ts))
    assert [r.status for r in records] == ["Success", "Failed", "Failed", "Success"]
    assert rows(store.read("target"), "vacode", "rgcd", "vaname") == [
        ("S1", "AUS", "one"),
        ("S2", "AUS", "two, quoted"),
        ("S3", "AUS", "three"),
    ]
    audit = spark.read.parquet(f"{store.root}/{AUDIT}")
    assert rows(audit, "status") == [("Failed",), ("Failed",), ("Success",), ("Success",)]
    head = store.head()
    two_regions = replace(SUPPLIER, files={"OCA": "OCASUPPLR_2024", "AUS": "AUSSUPPLR_2024"})
    again = run_day(store, two_regions, str(landing), DAY, RunOptions(run_ts=run_ts))
    assert again[0].region == "OCA" and "PATH_NOT_FOUND" in again[0].error_message
    assert [r.status for r in again] == ["Failed", "Skipped", "Failed", "Failed", "Skipped"] and store.head() == head


def test_run_day_skips_loaded_files(spark, landing, tmp_path, run_ts):
    store = open_store(spark, str(tmp_path / "store"), SUPPLIER)
    run_day(store, SUPPLIER, str(landing), DAY, RunOptions(run_ts=run_ts))
    head = store.head()
    again = run_day(store, SUPPLIER, str(landing), DAY, RunOptions(run_ts=run_ts))
    assert [r.status for r in again] == ["Skipped"] and store.head() == head


def test_ingest_stream_loads_each_file_once(spark, landing, tmp_path, run_ts):
    store = open_store(spark, str(tmp_path / "store"), SUPPLIER)

    def poll():
        args = (store, SUPPLIER, str(landing / "AUS"), str(tmp_path / "checkpoint"), "AUS", RunOptions(run_ts=run_ts))
        ingest_stream(*args).awaitTermination()
        return store.head()

    assert poll().version == 1 and poll().version == 1
    # A reordered, lower-case header is read by name.
    put(landing / "AUS", "AUSSUPPLR_2024_20240509.csv", "vaname,vacode\nnine,S9\nuno,S1\n")
    put(landing / "AUS", "AUSSUPPLR_2024_20240509.csv.pgp", "secret")
    assert poll().version == 2
    audit = spark.read.parquet(f"{store.root}/{AUDIT}").filter("status = 'Failed'")
    assert rows(audit, "file_name") == [("AUSSUPPLR_2024_20240509.csv.pgp",)]
    assert rows(store.read("target"), "vacode", "vaname") == [("S1", "uno"), ("S2", "two, quoted"), ("S9", "nine")]


def test_stream_rows_refuses_another_header(spark, tmp_path):
    put(tmp_path / "s", "a.csv", "a,b\n1,2\n")

    def load(name):
        out = str(tmp_path / f"out-{name}")
        writer = stream_rows(spark, str(tmp_path / "s"), ["a", "b"]).writeStream.format("parquet")
        writer = writer.option("checkpointLocation", str(tmp_path / f"cp-{name}")).trigger(availableNow=True)
        writer.start(out).awaitTermination()
        return read_table(spark, out)

    assert rows(load("good")) == [("1", "2")]
    put(tmp_path / "s", "b.csv", "b,a\n2,1\n")
    with pytest.raises(Exception, match="FAILED_READ_FILE"):
        load("bad")


def test_append_and_replace(spark, tmp_path):
    df, where = spark.range(3), str(tmp_path / "t")
    append_table(df, where)
    append_table(df, where)
    assert read_table(spark, where).count() == 6
    replace_table(df, where)
    assert read_table(spark, where).count() == 3
