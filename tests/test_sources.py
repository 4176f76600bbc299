from __future__ import annotations

import pytest
from conftest import rows
from pyspark.sql import functions as F

from wanderbeam import session
from wanderbeam.functions import json
from wanderbeam.operators import quality
from wanderbeam.sources import delimited, documents, exports, tables


def bucket_files(root):
    """Files of every bucket, with their names: a bucket that is written again gets new ones."""
    return {p.name: sorted(f.name for f in p.glob("*.parquet")) for p in root.glob("buckets=*/bucket=*")}


def test_upsert_creates_and_merges(spark, tmp_path):
    root = tmp_path / "features"
    assert tables.bucket_count(spark, str(root)) is None
    base = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "k long, v string")
    assert rows(tables.feature_upsert(spark, str(root), base, ["k"])) == rows(base)
    delta = spark.createDataFrame([(2, "B", 1), (3, "C", 2), (None, "N", 3)], "k long, v string, extra int")
    merged = tables.feature_upsert(spark, str(root), delta, ["k"])
    assert merged.columns == ["k", "v", "extra"]
    assert rows(merged) == sorted([(1, "a", None), (2, "B", 1), (3, "C", 2), (None, "N", 3)], key=repr)
    assert not (root / "_lock").exists() and not (root / "_pending").exists()


def test_one_key_rewrites_one_bucket(spark, tmp_path):
    root = tmp_path / "features"
    base = spark.range(200).select(F.col("id").alias("k"), F.lit("a").alias("v"))
    tables.feature_upsert(spark, str(root), base, ["k"], buckets=8)
    before = bucket_files(root)
    assert len(before) == 8 and all(len(names) == 1 for names in before.values())
    merged = tables.feature_upsert(spark, str(root), spark.createDataFrame([(5, "b")], "k long, v string"), ["k"])
    after = bucket_files(root)
    assert len([b for b in after if after[b] != before[b]]) == 1
    assert merged.count() == 200 and merged.where("v = 'b'").count() == 1


def test_a_merge_reads_the_touched_buckets_only(spark, tmp_path):
    root = str(tmp_path / "features")
    tables.feature_upsert(spark, root, spark.range(50).select(F.col("id").alias("k")), ["k"], buckets=8)
    some = spark.read.parquet(root).filter(F.col("bucket").isin([3]))
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan
    assert {p.split("bucket=")[1].split("/")[0] for p in some.inputFiles()} >= {"3"}


def test_a_broken_merge_is_finished_by_the_next(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "features")
    tables.feature_upsert(spark, root, spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string"), ["k"], buckets=4)
    replace = tables._replace_buckets

    def broken(*args):
        raise RuntimeError("lost")

    monkeypatch.setattr(tables, "_replace_buckets", broken)
    with pytest.raises(RuntimeError, match="lost"):
        tables.feature_upsert(spark, root, spark.createDataFrame([(1, "A")], "k long, v string"), ["k"])
    assert rows(tables.read_features(spark, root)) == [(1, "a"), (2, "b")]
    monkeypatch.setattr(tables, "_replace_buckets", replace)
    merged = tables.feature_upsert(spark, root, spark.createDataFrame([(3, "c")], "k long, v string"), ["k"])
    assert rows(merged) == [(1, "A"), (2, "b"), (3, "c")]


def test_two_merges_at_once_are_refused(spark, tmp_path):
    root = tmp_path / "features"
    frame = spark.createDataFrame([(1, "a")], "k long, v string")
    tables.feature_upsert(spark, str(root), frame, ["k"])
    (root / "_lock").touch()
    with pytest.raises(RuntimeError, match="another merge"):
        tables.feature_upsert(spark, str(root), frame, ["k"])


def test_upsert_keeps_what_the_delta_lacks(spark):
    base = spark.createDataFrame([(1, "a", 5), (2, "b", 6), (None, "n", 7)], "k long, v string, w int")
    delta = spark.createDataFrame([(2, 60, "x"), (None, 70, "y"), (4, 80, "z")], "k long, w int, extra string")
    merged = tables.upserted(base, delta, ["k"])
    assert merged.columns == ["k", "v", "w", "extra"]
    assert rows(merged) == sorted(
        [(1, "a", 5, None), (2, "b", 60, "x"), (None, "n", 70, "y"), (4, None, 80, "z")], key=repr
    )


def test_upsert_refuses_two_rows_for_a_key(spark):
    base = spark.createDataFrame([(1, "a")], "k long, v string")
    with pytest.raises(ValueError, match="several rows"):
        tables.upserted(base, spark.createDataFrame([(1, "b"), (1, "c")], "k long, v string"), ["k"])


def test_snapshot_buckets_follow_the_bytes(spark, tmp_path):
    frame = spark.range(100).select("id", F.col("id").cast("string").alias("v"))
    tables.publish_snapshot(frame, "snapshot_sized", "id", str(tmp_path / "s"), bucket_bytes=500)
    found = spark.sql("DESCRIBE EXTENDED snapshot_sized").where("col_name = 'Num Buckets'").first()[1]
    assert int(found) > 4 and len(list((tmp_path / "s").glob("*.parquet"))) <= int(found)


def test_delimited_lists_keep_nulls_and_empty_lists(spark, tmp_path):
    frame = spark.createDataFrame(
        [("u1", ["a", None, "b"]), ("u2", []), ("u3", None), ("u4", [""]), ("u5", ["\\N", "\\E", None])],
        "u string, s array<string>",
    )
    path = str(tmp_path / "csv")
    delimited.write_delimited(frame, path)
    got = dict(rows(delimited.read_delimited(spark, path, frame.schema)))
    want = dict(rows(frame))
    want["u4"] = got["u4"]  # an empty text is a missing one in such files
    assert got == want


def test_append_with_new_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.append_evolving(spark.range(1).toDF("a"), path)
    tables.append_evolving(spark.createDataFrame([(5, "x")], "a long, b string"), path)
    assert rows(tables.scan(spark, path, merge_schema=True), "a", "b") == [(0, None), (5, "x")]


def test_overwrite_replaces_the_schema(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.overwrite(spark.range(1).toDF("a"), path)
    tables.overwrite(spark.createDataFrame([("x",)], "b string"), path)
    assert tables.scan(spark, path).columns == ["b"]


def test_parameters_are_bound(spark):
    got = tables.parameterised(spark, "SELECT :v AS v, date_sub(:d, 1) AS d FROM {one}", {"v": "a' OR 1=1", "d": "2024-01-02"}, one=spark.range(1))
    assert got.first()["v"] == "a' OR 1=1"
    assert str(got.first()["d"]) == "2024-01-01"


def test_snapshot_joins_without_shuffling_it(spark, tmp_path):
    frame = spark.range(100).select("id", F.col("id").cast("string").alias("v"))
    published = tables.publish_snapshot(frame, "snapshot_test", "id", str(tmp_path / "s"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = published.alias("a").join(published.alias("b"), "id")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and joined.count() == 100
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_delimited_roundtrip(spark, tmp_path):
    frame = spark.createDataFrame(
        [("u1", ["a", "b"], [1.5, 2.0], 3)], "u string, s array<string>, d array<double>, n bigint"
    )
    many = frame.crossJoin(spark.range(25)).drop("id").coalesce(1)
    path = tmp_path / "csv"
    delimited.write_delimited(many, str(path), rows_per_file=10)
    assert len(list(path.glob("*.csv"))) == 3
    assert next(iter(path.glob("*.csv"))).read_text().splitlines()[:2] == ["u|s|d|n", "u1|a,b|1.5,2.0|3"]
    assert rows(delimited.read_delimited(spark, str(path), many.schema)) == rows(many)


def test_materialise_reads_back_what_was_written(spark):
    frame = spark.range(10).withColumn("p", F.spark_partition_id())
    written = session.materialise(frame, "t")
    assert rows(written) == rows(written) and written.count() == 10
    assert written.inputFiles()[0].split("file:")[-1].lstrip("/").startswith(
        session.scratch_dir(spark).split("file:")[-1].lstrip("/")
    )


@pytest.fixture
def exported(spark, tmp_path):
    frame = spark.range(500).select("id", F.concat(F.lit("v"), F.col("id")).alias("v"), F.array("id", F.col("id") + 1).alias("s"))
    return frame, str(tmp_path / "export")


def test_a_killed_export_goes_on_without_a_double_row(spark, exported, monkeypatch):
    frame, path = exported
    assert exports.export_chunks(frame, path, ["id"], chunks=10, waves=5, stop_after=2) == 4
    with pytest.raises(exports.DamagedExport, match=r"\[4, 5, 6, 7, 8, 9\]"):
        exports.read_export(spark, path, frame.schema, 10)
    measure = exports._measured

    def killed(*args):
        raise RuntimeError("killed between the files and the manifest")

    monkeypatch.setattr(exports, "_measured", killed)
    with pytest.raises(RuntimeError, match="killed"):
        exports.export_chunks(frame, path, ["id"], chunks=10, waves=5)
    monkeypatch.setattr(exports, "_measured", measure)
    assert exports.export_chunks(frame, path, ["id"], chunks=10, waves=5) == 6
    assert exports.export_chunks(frame, path, ["id"], chunks=10, waves=5) == 0
    assert rows(exports.read_export(spark, path, frame.schema, 10)) == rows(frame)
    assert exports.manifest(spark, path).count() == 10


def test_a_changed_byte_is_found(spark, exported, tmp_path):
    frame, path = exported
    exports.export_chunks(frame, path, ["id"], chunks=4, waves=1)
    file = sorted((tmp_path / "export" / "data" / "__chunk=2").glob("*.csv"))[0]
    body = file.read_bytes()
    file.write_bytes(body.replace(b"|v", b"|w", 1))
    for crc in file.parent.glob(".*.crc"):
        crc.unlink()
    with pytest.raises(exports.DamagedExport, match=r"\[2\]"):
        exports.read_export(spark, path, frame.schema, 4)


def test_empty_chunks_are_whole(spark, exported):
    frame, path = exported
    some = frame.filter("id < 2")
    exports.export_chunks(some, path, ["id"], chunks=8, waves=2)
    assert rows(exports.read_export(spark, path, some.schema, 8)) == rows(some)


def test_a_load_is_profiled_while_it_is_written(spark, tmp_path):
    path = str(tmp_path / "table")
    frame = spark.createDataFrame([(1, "a"), (2, None)], "k long, v string")
    metrics = quality.profile_metrics(["v"], ["k"])
    jobs = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("observed", "load")
    seen = tables.load_observed(frame, path, metrics, {"rows": F.count(F.lit(1)) > 1})
    assert len(jobs.getJobIdsForGroup("observed")) == 1
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert seen == {"n_rows": 2, "v_nulls": 1, "first_k": 1, "last_k": 2}
    assert rows(spark.read.parquet(path)) == rows(frame)


def test_a_load_that_breaks_a_rule_is_refused(spark, tmp_path):
    path = tmp_path / "table"
    frame = spark.createDataFrame([(1, "a"), (2, None)], "k long, v string")
    with pytest.raises(tables.RefusedLoad, match="no nulls") as refused:
        tables.load_observed(frame, str(path), {"n": F.count(F.lit(1))}, {"no nulls": F.count_if(F.col("v").isNull()) == 0, "rows": F.count(F.lit(1)) > 0})
    assert not path.exists() and refused.value.broken == ["no nulls"] and refused.value.profile == {"n": 2}
    assert spark.read.parquet(refused.value.staged).count() == 2


def test_documents_are_parsed_once_and_broken_ones_set_apart(spark, tmp_path):
    frame = spark.createDataFrame(
        [(1, '{"a": {"b": [7]}}', "[]"), (2, '{"a": ', "{}"), (3, None, None), (4, '{"a": 1}', "x{"), (5, "", "}")],
        "k long, d string, e string",
    )
    path = str(tmp_path / "documents")
    documents.parsed(frame, ["d", "e"]).write.partitionBy("broken").parquet(path)
    table = spark.read.parquet(path)
    whole = documents.whole(table)
    assert rows(whole.select("k", json.field(whole, "d", "a.b[0]", "bigint"))) == [(1, 7), (3, None)]
    assert rows(documents.quarantined(table, ["d", "e"]), "k", "reason", "d", "e") == [
        (2, "d", '{"a": ', "{}"), (4, "e", '{"a": 1}', "x{"), (5, "d,e", "", "}"),
    ]
    assert rows(frame.filter("k = 1").select(json.field(frame, "d", "a.b[0]", "bigint"))) == [(7,)]


def test_scratch_tables_are_dropped_by_their_owner(spark, monkeypatch):
    monkeypatch.setattr(session, "_WRITTEN", {})
    monkeypatch.setattr(session, "_DROPS", {})
    first = session.materialise(spark.range(3), "mine").inputFiles()[0]
    second = session.materialise(spark.range(3), "mine").inputFiles()[0]
    age = session.scratch_age(spark)
    assert session.drop_scratch(spark) == 2 and session.scratch_age(spark) == age + 1
    for path in (first, second):
        found = spark._jvm.org.apache.hadoop.fs.Path(path)
        assert not found.getFileSystem(spark._jsc.hadoopConfiguration()).exists(found)
