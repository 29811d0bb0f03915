import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from phenospark.operators.clean import clean
from phenospark.operators.consistency import consistency_filter
from phenospark.operators.features import all_features
from phenospark.operators.smooth import apply_smoothing
from phenospark.plans.preprocess import preprocess
from phenospark.schema import LABELS, MissingColumnsError
from phenospark.sources import readers, shared, writers
from .conftest import column


@pytest.fixture
def raw_csv(tmp_path):
    path = tmp_path / "raw.csv"
    lines = ["latitude,longitude,date,ndvi_raw"]
    for m in range(24):
        lines.append(f"40.0,-74.0,{2020 + m // 12}-{m % 12 + 1:02d}-10,{3000 + 200 * (m % 12)}")
    path.write_text("\n".join(lines))
    return str(path)


def test_raw_file_to_features(spark, raw_csv, tmp_path):
    raw = readers.read_raw(spark, raw_csv)
    series = preprocess(raw)
    summary = writers.save_processed(series, str(tmp_path / "out")).first()
    assert (summary["records"], summary["locations"]) == (24, 1)
    assert summary["first_date"] == dt.date(2020, 1, 1)
    assert 0.29 <= summary["lowest"] <= summary["highest"] <= 0.53
    back = readers.read_processed(spark, str(tmp_path / "out"))
    profile = writers.save_features(all_features(back), str(tmp_path / "features"))
    assert profile.where("feature = 'ndvi_lag_1'").first()["non_null"] == 23
    features, labels = readers.load_training_tables(
        spark, str(tmp_path / "features"), str(tmp_path / "none"))
    assert features.count() == 24 and labels is None


def test_csv_series_round_trip(spark, make_series, tmp_path):
    df = apply_smoothing(make_series([0.1, None, 0.3]))
    writers.save_processed(df, str(tmp_path / "csv"), fmt="csv")
    back = readers.read_processed(spark, str(tmp_path / "csv"), fmt="csv")
    assert column(back, "ndvi_raw") == [0.1, None, 0.3]


def test_file_without_the_columns(spark, tmp_path):
    df = spark.range(3)
    df.write.parquet(str(tmp_path / "x"))
    with pytest.raises(MissingColumnsError):
        readers.read_raw(spark, str(tmp_path / "x"), fmt="parquet")


def test_row_numbers_part_exact_copies(spark, tmp_path):
    rows = [(1.0, 2.0, dt.date(2020, 1, 1), 0.2 if i % 2 else 0.9) for i in range(200)]
    spark.createDataFrame(
        rows, "latitude double, longitude double, date date, ndvi_raw double"
    ).write.parquet(str(tmp_path / "raw"))
    raw = readers.read_raw(spark, str(tmp_path / "raw"), fmt="parquet", row_number=True)
    assert raw.select("obs_id").distinct().count() == 200
    keyed = clean(raw, scale="never")
    plain = consistency_filter(keyed, tie_break=["obs_id"], drop=False)
    cut = consistency_filter(keyed, tie_break=["obs_id"], drop=False, min_rows=20, share=0.0)
    assert column(cut, "ndvi_raw", "obs_id") == column(plain, "ndvi_raw", "obs_id")


def test_extracts_of_two_layouts(spark, tmp_path):
    (tmp_path / "a1.csv").write_text("Latitude,Longitude,Date,NDVI\n1.0,2.0,2020-01-01,5000\n")
    (tmp_path / "a2.csv").write_text("Latitude,Longitude,Date,NDVI\n1.0,2.0,2020-02-01,6000\n")
    (tmp_path / "b.csv").write_text("latitude,longitude,date,ndvi_raw,quality\n3.0,4.0,2020-01-01,1000,2\n")
    first = "Latitude double, Longitude double, Date date, NDVI double"
    second = "latitude double, longitude double, date date, ndvi_raw double, quality int"
    groups = [(str(tmp_path / "a*.csv"), spark.createDataFrame([], first).schema),
              (str(tmp_path / "b.csv"), spark.createDataFrame([], second).schema)]
    out = readers.read_extracts(spark, groups)
    assert out.columns == ["latitude", "longitude", "date", "ndvi_raw", "quality"]
    assert column(out, "ndvi_raw", "ndvi_raw") == pytest.approx([0.1, 0.5, 0.6])
    assert column(out, "quality", "ndvi_raw") == [2, None, None]


def test_no_labels_are_written_typed(spark, tmp_path):
    writers.save_labels(None, str(tmp_path / "l"), spark)
    back = readers.read_labels(spark, str(tmp_path / "l"))
    assert back.count() == 0 and back.columns == LABELS.names


def test_metrics_file(spark, tmp_path):
    writers.save_metrics(spark.range(1).select(F.lit(0.5).alias("mae")), str(tmp_path / "m"))
    files = [f for f in os.listdir(tmp_path / "m") if f.endswith(".json")]
    assert json.loads((tmp_path / "m" / files[0]).read_text()) == {"mae": 0.5}


def test_tables_by_year_prune(spark, make_series, tmp_path):
    writers.write_table(make_series([0.5] * 30), str(tmp_path / "y"), by_year=True)
    assert sorted(f for f in os.listdir(tmp_path / "y") if f.startswith("year")) == [
        "year=2020", "year=2021", "year=2022"]
    assert spark.read.parquet(str(tmp_path / "y")).where("year = 2021").count() == 12


class Session:
    """A session that answers with one setting."""

    def __init__(self, value):
        self.conf = self
        self.value = value

    def get(self, name, default):
        if name != "spark.checkpoint.dir":
            return default  # no warehouse named either: Spark's own default holds
        return self.value or default


def test_intermediate_tables_go_where_the_session_says(spark):
    folder = shared.shared_folder(Session("hdfs://cluster/tmp/"), "x")
    assert folder.startswith("hdfs://cluster/tmp/phenospark/x-")
    assert folder != shared.shared_folder(Session("hdfs://cluster/tmp/"), "x")
    assert shared.shared_folder(Session(None), "x").startswith("/")
    assert shared.stored(spark.range(5), "x").count() == 5
