"""Sources and sinks: CSV quoting, missing tokens, existence check, Parquet round trip, streaming."""

import os

import pytest
from pyspark.sql import functions as F

from strata.session import scratch_path
from strata.sources.export import export_marts, read_manifest
from strata.sources.raw_csv import load_raw
from tests.fixtures import raw_extract


def test_csv_quotes_newlines_and_tokens(spark, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text(
        'YearStart,Topic,Question,DataValue,DataValueAlt,DataSource\n'
        '2010,"Heart ""and"" lungs","Line one\nline two",12,"1,000","NVSS, Mortality"\n'
        '2011,NA,,N/A,5.5,null\n'
    )
    df = load_raw(spark, str(path))
    rows = df.orderBy("YearStart").collect()
    assert len(rows) == 2
    assert rows[0].Topic == 'Heart "and" lungs' and rows[0].Question == "Line one\nline two"
    assert rows[0].DataSource == "NVSS, Mortality" and rows[0].DataValueAlt == "1,000"
    assert rows[1].Topic is None and rows[1].Question is None and rows[1].DataValue is None
    assert rows[1].DataSource is None and df.schema["YearStart"].dataType.simpleString() == "int"


def test_missing_file_raises(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        load_raw(spark, str(tmp_path / "nope.csv"))


def test_pipeline_round_trip(spark):
    from strata.plans.cleaning import CleanReport, run_pipeline
    report = CleanReport()
    out = run_pipeline(spark, raw_extract(spark, 300), scratch_path(spark, "t-processed"), report=report)
    assert out.count() == report.rows_out == 300
    assert "DataValueFootnoteSymbol" not in out.columns and "LocationAbbr_enc" in out.columns
    assert any(c.startswith("topic_") for c in out.columns)
    assert out.filter("YearStart >= 2015").select("YearStart").distinct().count() > 0


def test_export_manifest(spark):
    df = raw_extract(spark, 50).groupBy("Topic").count()
    paths = export_marts({"by_topic": df}, scratch_path(spark, "t-extracts"))
    assert read_manifest(spark, paths).first().rows == df.count()


def test_streaming_ingest_matches_batch(spark, tmp_path):
    from strata.streaming import clean_rows, start_ingest
    raw = raw_extract(spark, 200)
    src = str(tmp_path / "incoming")
    raw.write.option("header", True).option("escape", '"').csv(src)
    schema = spark.read.option("header", True).csv(src).schema
    out = str(tmp_path / "out")
    q = start_ingest(spark, src, schema, out, checkpoint=str(tmp_path / "ckpt"))
    q.awaitTermination(120)
    streamed = spark.read.parquet(out)
    batch = clean_rows(spark.read.option("header", True).option("escape", '"').schema(schema).csv(src))
    cols = ["Topic", "DataValueAlt", "Latitude", "risk_level", "is_mortality"]
    assert sorted(streamed.select(*cols).collect()) == sorted(batch.select(*cols).collect())


def test_scale_conf_bounds():
    from strata.session import scale_conf
    big = scale_conf(100 * 10**12, 1000, 8, 32 * 1024)
    assert 350_000 < int(big["spark.sql.shuffle.partitions"]) < 400_000 and big["spark.sql.files.maxPartitionBytes"] == "256m"
    small = scale_conf(10**9, 4, 8, 2048)
    assert int(small["spark.sql.shuffle.partitions"]) >= 64
    assert small["spark.sql.files.maxPartitionBytes"] == "64m"


class Cluster:
    """The parts of a session that the scratch folder looks at."""

    def __init__(self, master, folder=None):
        self.settings = {"spark.checkpoint.dir": folder} if folder else {}
        self.conf = type("Conf", (), {"get": lambda _, k, d=None: self.settings.get(k, d),
                                      "set": lambda _, k, v: self.settings.update({k: v})})()
        launch = type("Launch", (), {"get": lambda _, k, d=None: d})()
        self.sparkContext = type("Context", (), {"master": master, "getConf": lambda _: launch, "applicationId": "test"})()


def test_scratch_needs_a_shared_folder_off_one_machine(monkeypatch):
    from strata.session import SharedFolderError, checkpoint_root, scratch_path
    monkeypatch.delenv("STRATA_CHECKPOINT_DIR", raising=False)
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]", "k8s://x"):
        with pytest.raises(SharedFolderError):
            checkpoint_root(Cluster(master))
        assert scratch_path(Cluster(master, "hdfs://shared/dir/"), "t").startswith("hdfs://shared/dir/strata/t-")
    for master in ("local", "local[4]", "local[*]"):
        assert os.path.isdir(checkpoint_root(Cluster(master)))


def test_scratch_can_be_removed(spark):
    from strata.session import remove_scratch
    path = scratch_path(spark, "t-remove")
    spark.range(3).write.parquet(path)
    assert remove_scratch(spark) >= 1 and not os.path.exists(path.removeprefix("file:"))
    assert remove_scratch(spark) == 0
