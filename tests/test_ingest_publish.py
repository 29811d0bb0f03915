import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from phenospark.schema import LABELS, RAW
from phenospark.sources import ingest as ing
from phenospark.sources.publish import SchemaChangedError, publish, read_published

KNOWN = T.StructType([*RAW.fields, T.StructField("quality", T.IntegerType())])


@pytest.fixture
def extracts(tmp_path):
    home = tmp_path / "in"
    (home / "deep").mkdir(parents=True)
    (home / "a.csv").write_text(
        "Latitude,Longitude,Date,NDVI\n1.5,2.0,2020-01-01,5000\n1.5,2.0,2020-02-30,5000\n"
        "1.5,2.0\n1.5,2.0,2020-03-01,lots\n,2.0,2020-03-01,1\n91.0,2.0,2020-03-01,1\n"
        "1.5,2.0,2020-04-01,NaN\n\n1.5,2.0,2020-05-01,6000,7\n")
    (home / "b [x] 1.csv").write_text("date,ndvi_raw,latitude,longitude,quality,note\n"
                                      "2020-01-01,1000,3.0,4.0,2,\"a, b\"\n2020-01-02,1000,3.0,4.0,two,c\n")
    (home / "deep" / "c.csv").write_text("place,NDVI\nx,1\n")
    (home / "header.csv").write_text("Latitude,Longitude,Date,NDVI\n")
    (home / "empty.csv").write_text("")
    (home / "twice.csv").write_text("Latitude,latitude,Longitude,Date,NDVI\n1,1,1,2020-01-01,1\n")
    return str(home)


def test_no_line_is_lost(spark, extracts, tmp_path):
    got = ing.ingest(spark, extracts, str(tmp_path / "t"), KNOWN)
    rows = got.accepted().orderBy("date", "latitude").collect()
    assert [(r["latitude"], r["date"], r["ndvi_raw"], r["quality"], r["note"]) for r in rows] == [
        (1.5, dt.date(2020, 1, 1), pytest.approx(0.5), None, None),
        (3.0, dt.date(2020, 1, 1), pytest.approx(0.1), 2, "a, b"),
    ]
    reasons = {r[0]: r[1] for r in got.rejects().groupBy("rejected_for").count().collect()}
    assert reasons == {"malformed": 5, "missing latitude": 1, "off the globe": 1,
                       "missing ndvi_raw": 1, "header": 4}
    texts = {r["record"] for r in got.rejects().where("rejected_for IN ('malformed', 'header')").collect()}
    assert {"1.5,2.0,2020-02-30,5000", "1.5,2.0", "1.5,2.0,2020-05-01,6000,7", "place,NDVI", "x,1"} <= texts
    counts = {r["source_file"].rsplit("/", 1)[1]: (r["accepted"], r["rejected"])
              for r in got.counts().collect()}
    assert counts == {"a.csv": (1, 7), "b%20%5Bx%5D%201.csv": (1, 1), "c.csv": (0, 2),
                      "header.csv": (0, 0), "twice.csv": (0, 2)}


def test_a_count_of_one_column_sees_the_same_rejects(spark, extracts, tmp_path):
    got = ing.ingest(spark, extracts, str(tmp_path / "t"), KNOWN)
    assert got.rejects().select("latitude").count() == 12


def test_a_second_run_replaces_the_first(spark, extracts, tmp_path):
    for _ in range(2):
        got = ing.ingest(spark, extracts, str(tmp_path / "t"), KNOWN)
    assert got.rows.count() == 14


def test_only_strange_or_empty_files(spark, tmp_path):
    (tmp_path / "x.csv").write_text("a,b\n")
    (tmp_path / "y.csv").write_text("")
    got = ing.ingest(spark, [str(tmp_path / "y.csv")], str(tmp_path / "t"))
    assert got.rows.count() == 0 and got.counts().count() == 0
    assert got.accepted().columns == [*RAW.names, "source_file"]
    got = ing.ingest(spark, [str(tmp_path / "x.csv")], str(tmp_path / "t"))
    assert got.accepted().count() == 0 and got.rejects().first()["record"] == "a,b"


def test_a_layout_is_one_read_however_many_files(spark, tmp_path):
    home = tmp_path / "many"
    home.mkdir()
    for i in range(40):
        (home / f"{i}.csv").write_text(f"Latitude,Longitude,Date,NDVI\n1,2,2020-01-01,{i}\n")
    got = ing.ingest(spark, str(home), str(tmp_path / "t"))
    assert got.accepted().agg(F.sum("ndvi_raw")).first()[0] == pytest.approx(0.078)


@pytest.mark.parametrize("header", ["", "a,a", "latitude,longitude,date", "record,latitude,longitude,date,ndvi_raw"])
def test_unknown_layouts(header):
    assert ing.layout_of(header or ",", RAW, RAW.names) is None


def rows_of(df):
    return sorted((r["location_id"], r["year"], r["label_quality_score"]) for r in df.collect())


@pytest.fixture
def labels(spark):
    def make(*rows):
        data = [(p, y, dt.date(y, 4, 1), 3, q, 1.0, 2.0) for p, y, q in rows]
        return spark.createDataFrame(data, LABELS)

    return make


def test_published_twice_is_published_once(spark, labels, tmp_path):
    path = str(tmp_path / "l")
    df = labels(("a", 2020, 0.1), ("a", 2021, 0.2), ("b", 2021, 0.3))
    for _ in range(2):
        back = publish(df, path)
    assert rows_of(back) == rows_of(df) and back.schema.names == LABELS.names


def test_a_re_run_replaces_its_years_and_leaves_the_others(spark, labels, tmp_path):
    path = str(tmp_path / "l")
    publish(labels(("a", 2019, 0.1), ("a", 2020, 0.2), ("b", 2020, 0.3), ("a", 2021, 0.4)), path)
    back = publish(labels(("a", 2020, 0.9)), path)
    assert rows_of(back) == [("a", 2019, 0.1), ("a", 2020, 0.9), ("a", 2021, 0.4)]
    back = publish(labels(("c", 2020, 0.5)), path, covers=(2020, 2022))
    assert rows_of(back) == [("a", 2019, 0.1), ("c", 2020, 0.5)]
    assert rows_of(publish(labels(("d", 2022, 0.6)), path)) == [
        ("a", 2019, 0.1), ("c", 2020, 0.5), ("d", 2022, 0.6)]


@pytest.mark.parametrize("covers", [None, (2020, 2021)])
def test_an_empty_table_is_typed(spark, labels, tmp_path, covers):
    back = publish(labels(), str(tmp_path / "l"), covers)
    assert back.count() == 0
    assert [(f.name, f.dataType) for f in back.schema] == [(f.name, f.dataType) for f in LABELS]


def test_years_of_their_own(spark, tmp_path):
    rows = spark.createDataFrame(
        [("a", dt.date(2020, 5, 1)), ("a", None)], "location_id string, date date")
    for _ in range(2):
        back = publish(rows, str(tmp_path / "r"))
    assert sorted((r["year"] is None, r["year"]) for r in back.collect()) == [(False, 2020), (True, None)]
    assert "year" in back.columns


def test_other_columns_and_no_table(spark, labels, tmp_path):
    path = str(tmp_path / "l")
    with pytest.raises(FileNotFoundError):
        read_published(spark, path)
    publish(labels(("a", 2020, 0.1)), path)
    with pytest.raises(SchemaChangedError):
        publish(labels(("a", 2020, 0.1)).drop("latitude"), path)
    with pytest.raises(ValueError):
        publish(labels().withColumn("published_row", F.lit(1)), path)


def test_a_year_is_pruned(spark, labels, tmp_path):
    publish(labels(("a", 2020, 0.1), ("a", 2021, 0.2)), str(tmp_path / "l"))
    one = read_published(spark, str(tmp_path / "l")).where("year = 2021")
    assert one.select("_metadata.file_path").distinct().count() == 1
    assert "year=2021" in one.select("_metadata.file_path").first()[0]
