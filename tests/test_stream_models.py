import random

import pytest
from pyspark.errors import StreamingQueryException

from phenospark.operators.train import predict, train_model
from phenospark.streaming import models

SCHEMA = "location_id string, date date, a double, b double, bloom_label int"


@pytest.fixture(scope="module")
def two_models(spark):
    rng = random.Random(5)
    import datetime as dt
    rows = []
    for i in range(80):
        a, b = rng.random(), rng.random()
        rows.append((f"p{i}", dt.date(2020, 1, 1) + dt.timedelta(i), a, b, int(a > 0.5)))
    table = spark.createDataFrame(rows, SCHEMA).coalesce(1)
    fitted = [
        train_model(table, "randomforest", "classification", numTrees=n, maxDepth=depth)
        for n, depth in ((5, 1), (20, 4))
    ]
    return table, rows, fitted


def scores(df):
    return {r["location_id"]: (r["prediction"], r["score"]) for r in df.collect()}


def test_a_newer_model_is_picked_up_between_batches(spark, two_models, tmp_path):
    table, rows, (old, new) = two_models
    registry, arrivals = str(tmp_path / "registry"), str(tmp_path / "arrivals")
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    parts = [spark.createDataFrame(rows[i::4], SCHEMA).coalesce(1) for i in range(4)]
    parts[0].write.parquet(arrivals)
    arriving = spark.readStream.schema(table.schema).option("maxFilesPerTrigger", 1).parquet(arrivals)

    def run():
        models.write_model_scores(arriving, registry, out, state).awaitTermination()

    with pytest.raises(StreamingQueryException, match="no model"):
        run()
    assert models.publish_model(spark, old, registry) == 1
    run()  # the batch that failed is scored now
    parts[1].write.mode("append").parquet(arrivals)
    run()
    assert models.publish_model(spark, new, registry) == 2
    parts[2].write.mode("append").parquet(arrivals)
    parts[3].write.mode("append").parquet(arrivals)
    run()
    got = spark.read.parquet(out)
    assert got.count() == len(rows)
    for version, model, mine in ((1, old, rows[0::4] + rows[1::4]), (2, new, rows[2::4] + rows[3::4])):
        wanted = scores(predict(model, spark.createDataFrame(mine, SCHEMA), ("location_id", "date")))
        assert scores(got.where(f"{models.VERSION} = {version}")) == wanted
    run()  # nothing arrived
    assert spark.read.parquet(out).count() == len(rows)


def test_one_running_stream_changes_models(spark, two_models, tmp_path, monkeypatch):
    table, rows, (old, new) = two_models
    registry, arrivals, out = (str(tmp_path / n) for n in ("registry", "arrivals", "out"))
    for i in range(3):
        spark.createDataFrame(rows[i::3], SCHEMA).coalesce(1).write.mode("append").parquet(arrivals)
    models.publish_model(spark, old, registry)
    loaded, plain = [], models.load_model

    def load(session, place):
        if not loaded:  # while the first batch is under way
            models.publish_model(session, new, registry)
        loaded.append(place)
        return plain(session, place)

    monkeypatch.setattr(models, "load_model", load)
    arriving = spark.readStream.schema(table.schema).option("maxFilesPerTrigger", 1).parquet(arrivals)
    models.write_model_scores(arriving, registry, out, str(tmp_path / "state")).awaitTermination()
    by_batch = spark.read.parquet(out).select("batch", models.VERSION).distinct().collect()
    assert {tuple(r) for r in by_batch} == {(0, 1), (1, 2), (2, 2)}
    assert len(loaded) == 2  # once a version, not once a batch


def test_the_place_by_name_decides_between_equal_numbers(spark, tmp_path):
    assert models.newest_version(spark, str(tmp_path / "none")) is None
    for place in ("x", "z", "y"):
        spark.createDataFrame([(3, place)], models.VERSIONS).write.mode("append").json(str(tmp_path / "r/versions"))
    assert models.newest_version(spark, str(tmp_path / "r")) == (3, "z")
