from __future__ import annotations

import uuid

import pytest

from sluice.operators import load
from sluice.sources import database

TARGET = [(1, "a", 1.0), (2, "b", 2.0), (2, "c", 3.0), (3, "d", 4.0), (None, "n", 5.0)]
SCHEMA = "k int, name string, amount double"


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture
def target(spark):
    return spark.createDataFrame(TARGET, SCHEMA)


@pytest.fixture
def source(spark):
    return spark.createDataFrame([(2, ""), (2, "y"), (4, "z"), (None, "m")], "k int, name string")


EXPECTED = [
    (1, "a", 1.0), (3, "d", 4.0), (None, "n", 5.0),
    (2, None, None), (2, "y", None), (4, "z", None), (None, "m", None),
]


def test_upsert_deletes_by_key_and_adds_all(target, source):
    assert rows_of(load.upsert_rows(target, source, ["k"])) == sorted(EXPECTED, key=repr)


def test_upsert_with_unique_keys_is_idempotent(spark, target):
    source = spark.createDataFrame([(1, "new", 9.0), (7, "seven", 7.0)], SCHEMA)
    once = load.upsert_rows(target, source, ["k"])
    assert rows_of(load.upsert_rows(once, source, ["k"])) == rows_of(once)


def test_append_and_replace(target, source):
    assert load.append_rows(target, source).count() == len(TARGET) + 4
    replaced = load.replace_rows(target, source, {"amount": 7})
    assert replaced.columns == target.columns
    assert {r.amount for r in replaced.collect()} == {7.0}


def test_unknown_columns_and_wrong_arguments_are_errors(spark, target, source):
    with pytest.raises(ValueError):
        load.append_rows(target, spark.createDataFrame([(1, 2)], "k int, other int"))
    for how, keys in (("merge", None), ("upsert", None), ("append", ["k"])):
        with pytest.raises(ValueError):
            load.load_rows(target, source, how, keys)


def test_summary(target, source):
    row = load.load_summary(target, source, "upsert", ["k"]).first()
    assert tuple(row) == ("upsert", 4, 2, 7)


@pytest.fixture
def stored(spark, target):
    name = f"t_{uuid.uuid4().hex}"
    spark.sql(
        f"CREATE TABLE {name} (k int, name string, amount double DEFAULT 0.5) USING parquet"
    )
    target.write.insertInto(name)
    yield name
    spark.sql(f"DROP TABLE {name}")


@pytest.mark.parametrize(
    ("how", "keys", "deleted", "after"),
    [("append", None, 0, 9), ("replace", None, 5, 4), ("upsert", ["k"], 2, 7)],
)
def test_table_loads(spark, stored, source, how, keys, deleted, after):
    done = load.load_table(source, stored, how, keys)
    assert done == {
        "table": stored, "how": how, "rows_in": 4, "rows_deleted": deleted, "rows_after": after,
    }
    table = spark.table(stored)
    assert table.count() == after
    # the source has no amount, so its rows take the declared default
    assert table.filter("name = 'z'").first().amount == 0.5
    assert table.filter("k = 2 and name is null").count() == 1


def test_a_failed_load_leaves_the_table(spark, stored, source):
    bad = source.withColumnRenamed("name", "unknown")
    with pytest.raises(ValueError):
        load.load_table(bad, stored, "replace")
    assert rows_of(spark.table(stored)) == sorted(TARGET, key=repr)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith(f"{stored}__")]


def test_a_failed_swap_gives_the_name_back(spark, stored, source, monkeypatch):
    real, calls = type(spark).sql, []

    def sql(self, text, *args, **kwargs):
        if text.endswith(f"RENAME TO {stored}") and not calls:
            calls.append(text)
            raise RuntimeError("no")
        return real(self, text, *args, **kwargs)

    monkeypatch.setattr(type(spark), "sql", sql)
    with pytest.raises(RuntimeError):
        load.load_table(source, stored, "replace")
    assert rows_of(spark.table(stored)) == sorted(TARGET, key=repr)


def test_models_can_be_fitted_after_a_load(spark, stored, source):
    from pyspark.ml.classification import LinearSVC, RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler
    from pyspark.sql import functions as F

    load.load_table(source, stored, "upsert", ["k"])
    rows = spark.range(40).select((F.col("id") % 2).cast("double").alias("label"), F.col("id").cast("double").alias("x"))
    train = VectorAssembler(inputCols=["label", "x"], outputCol="features").transform(rows)
    for model in (RandomForestClassifier(numTrees=2), LinearSVC(maxIter=2)):
        assert model.fit(train).transform(train).select("prediction").count() == 40


def files_of(path):
    return {str(p.relative_to(path)) for p in path.rglob("*.parquet")}


@pytest.mark.parametrize("listed", [1000, 0])
def test_partitioned_upsert_leaves_other_files(spark, tmp_path, monkeypatch, listed):
    monkeypatch.setattr(load, "LISTED_PARTITIONS", listed)
    folder = tmp_path / "t"
    rows = [(i, f"n{i}", float(i), None if i % 5 == 0 else i % 5) for i in range(40)] + [(1, "again", 0.0, 1), (None, "no key", 1.0, 2)]
    schema = "k int, name string, amount double, part int"
    target = spark.createDataFrame(rows, schema)
    target.write.partitionBy("part").parquet(str(folder))
    before = files_of(folder)
    # Key 1 is replaced twice, 5 moves from the null partition, 77 is new in a new partition; null keys delete nothing.
    source = spark.createDataFrame([(1, "x", 1), (1, "y", 1), (5, "moved", 1), (77, "new", 9), (None, "", 1)], "k int, name string, part int")
    want = rows_of(load.upsert_rows(target, load.blanks_as_null(source), ["k"], {"amount": 0.5}))
    done = load.upsert_partitions(source, str(folder), ["k"], ["part"], {"amount": 0.5})
    assert rows_of(spark.read.parquet(str(folder)).select("k", "name", "amount", "part")) == want
    assert done["rows_in"] == 5 and done["rows_deleted"] == 3 and done["rows_after"] == 44
    untouched = {f for f in before if f.startswith(("part=2", "part=3", "part=4"))}
    assert untouched and untouched <= files_of(folder)


def test_partitioned_upsert_empties_a_partition(spark, tmp_path):
    folder = tmp_path / "t"
    spark.createDataFrame([(1, "a"), (2, "b/c d")], "k int, part string").write.partitionBy("part").parquet(str(folder))
    load.upsert_partitions(spark.createDataFrame([(2, "a")], "k int, part string"), str(folder), ["k"], ["part"])
    assert rows_of(spark.read.parquet(str(folder)).select("k", "part")) == [(1, "a"), (2, "a")]
    # With the partition in the key, the same key elsewhere is another row.
    load.upsert_partitions(spark.createDataFrame([(2, "z")], "k int, part string"), str(folder), ["k", "part"], ["part"])
    assert rows_of(spark.read.parquet(str(folder)).select("k", "part")) == [(1, "a"), (2, "a"), (2, "z")]


def test_database_options():
    server = database.connection("sqlserver", "host", "db", "user", "secret")
    assert server["url"] == "jdbc:sqlserver://host:1433;databaseName=db"
    assert database.connection("postgresql", "h", "d", "u", "p")["url"] == "jdbc:postgresql://h:5432/d"
    assert database.scan_options(query="select 1")["query"] == "select 1"
    split = database.scan_options(
        table="t", partition_column="id", bounds=(0, 100), partitions=4
    )
    assert (split["dbtable"], split["numPartitions"], split["upperBound"]) == ("t", "4", "100")
    assert database.fill_options("t") == {"dbtable": "t", "truncate": "true", "batchsize": "1000"}
    for wrong in ({}, {"query": "q", "table": "t"}, {"table": "t", "partition_column": "id"}):
        with pytest.raises(ValueError):
            database.scan_options(**wrong)
    with pytest.raises(ValueError):
        database.connection("other", "h", "d", "u", "p")
