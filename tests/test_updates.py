import pytest

from phenospark.streaming import updates

SCHEMA = "k long, v string"


@pytest.fixture
def table(spark, tmp_path):
    """Files that arrive one by one, and the table they go to."""
    class Table:
        path, state = str(tmp_path / "t"), str(tmp_path / "s")
        source = tmp_path / "in"

        def arrive(self, *batches):
            for n, rows in enumerate(batches, len(list(self.source.glob("*")))):
                spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{self.source}/n={n:03d}")

        def run(self, every=3):
            stream = (spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1)
                      .option("recursiveFileLookup", True).parquet(str(self.source)))
            updates.write_compacted(stream, self.path, self.state, ["k"], every).awaitTermination()

        def read(self):
            rows = updates.read_latest(
                spark, self.path, spark.createDataFrame([], SCHEMA).schema, ["k"])
            return {r["k"]: r["v"] for r in rows.collect()}

    return Table()


def test_newest_row_per_key_over_many_batches(spark, table):
    table.arrive(*[[(n % 4, f"v{n}"), (100 + n, "once")] for n in range(11)])
    table.run()
    expected = {n % 4: f"v{n}" for n in range(11)} | {100 + n: "once" for n in range(11)}
    assert table.read() == expected
    assert updates.last_snapshot(spark, table.path) == 2


def test_a_reader_touches_one_snapshot_and_the_batches_since(spark, table):
    table.arrive(*[[(n, "x")] for n in range(11)])
    table.run()
    schema = spark.createDataFrame([], SCHEMA).schema
    rows = updates._since(spark, table.path, schema, updates.last_snapshot(spark, table.path))
    folders = {f.rsplit("/", 2)[1] if "batch=" in f else "snapshot" for f in rows.inputFiles()}
    assert folders == {"snapshot", "batch=9", "batch=10"}


def test_restarts_go_on_where_they_were(spark, table):
    table.arrive(*[[(1, f"a{n}")] for n in range(4)])
    table.run()
    table.arrive(*[[(1, f"b{n}"), (2, None)] for n in range(3)])
    table.run()
    assert table.read() == {1: "b2", 2: None}


def test_a_snapshot_without_its_mark_does_not_count(spark, table):
    table.arrive(*[[(n, "x")] for n in range(4)])
    table.run(every=3)
    spark.createDataFrame([(9, "half", 8)], f"{SCHEMA}, batch long").write.parquet(
        f"{table.path}/snapshot/generation=1")
    assert table.read() == {n: "x" for n in range(4)}


def test_before_the_first_snapshot_and_before_any_batch(spark, table):
    assert table.read() == {}
    table.arrive([(1, "a")], [(1, "b")])
    table.run()
    assert table.read() == {1: "b"}


def test_a_log_column_of_ones_own(spark, table):
    with pytest.raises(ValueError):
        updates.write_compacted(spark.createDataFrame([], "k long, batch int"), "p", "s", ["k"])
