import gzip

import pytest
from pyspark.sql import functions as F

from rillmark.sources import readers, store
from rillmark.sources.schemas import SCHEMAS, same_shape
from rillmark.streaming.recording_days import recording_days


def test_csv_strict_and_permissive(spark, tmp_path):
    p = tmp_path / "a.csv.gz"
    with gzip.open(p, "wt") as f:
        f.write('id,name\n1,"x, y"\n2,z\nbad,row\n')
    from pyspark.sql import types as T

    s = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())])
    with pytest.raises(Exception):
        readers.read_csv(spark, [str(p)], s).collect()
    good, n = readers.split_corrupt(readers.read_csv(spark, [str(p)], s, strict=False).cache())
    assert [r.name for r in good.collect()] == ["x, y", "z"] and tuple(n.first()) == (3, 1)


def test_jsonl_counts_errors(spark, tmp_path):
    p = tmp_path / "a.jsonl"
    p.write_text('{"a": 1, "b": {"c": "x"}}\n\nnope\n{"a": 2}\n')
    rows, n = readers.read_jsonl(spark, [str(p)], "a long, b struct<c: string>")
    assert sorted(r.a for r in rows.collect()) == [1, 2] and tuple(n.first()) == (3, 1)


def test_readers_refuse(spark):
    with pytest.raises(ValueError):
        readers.read_parquet(spark, ["/x/*.parquet"])
    with pytest.raises(ValueError):
        readers.read_period(spark, "/x", "t", "2026-02-01", "2026-01-01")
    df = spark.createDataFrame([(1, 2)], "a int, user_id int")
    assert readers.firewall(df, ["a"]).columns == ["a"]
    with pytest.raises(ValueError):
        readers.firewall(df, ["user_id"], ["user_id"])


def test_manifest(spark, tmp_path):
    import hashlib

    (tmp_path / "a").write_bytes(b"1")
    (tmp_path / "b").write_bytes(b"2")
    m = {"a": hashlib.sha256(b"1").hexdigest(), "b": "0", "c": "0"}
    assert {r.name: r.state for r in readers.verify_manifest(spark, str(tmp_path), m).collect()} == {"a": "ok", "b": "differs", "c": "missing"}


def test_store_publishes_once_and_refuses(spark, tmp_path):
    st = store.Store(spark, str(tmp_path / "s"))
    one, two = spark.range(5), spark.range(7)
    none = {"negative": lambda df: df.where("id < 0").count()}
    assert st.publish("t", "r1", one, none, promote=True) and not st.publish("t", "r1", two, none)
    assert st.read("t").count() == 5
    with pytest.raises(store.Refused):
        st.publish("t", "r2", two, {"big": lambda df: df.where("id > 5").count()})
    with pytest.raises(store.Refused):
        st.publish("t", "r2", two, none, fail_at="staged")
    assert st.read("t").count() == 5 and list(st.manifest("t")["runs"]) == ["r1"]
    assert st.publish("t", "r2", two, none) and st.read("t").count() == 5
    st.promote("t", "r2")
    assert st.read("t").count() == 7 and st.read("t", "r1").count() == 5
    st.publish("u", "r1", one)
    st.swap("pair", {"t": "r2", "u": "r1"})
    assert {k: v.count() for k, v in st.swapped("pair").items()} == {"t": 7, "u": 5}
    with pytest.raises(store.Refused):
        st.promote("t", "r9")
    assert st.register("reg", "k", {"a": 1}) and not st.register("reg", "k", {"a": 1})
    with pytest.raises(store.Refused):
        st.register("reg", "k", {"a": 2})


def test_store_keeps_ids_apart_and_the_pointer_still(spark, tmp_path):
    st = store.Store(spark, str(tmp_path / "s"))
    ids = ["run:1", "run_1", "run/1", "run 1", "RUN_1", "run%3A1", "lauf:ä", "_3a"]
    for i, r in enumerate(ids):
        assert st.publish("d", r, spark.range(i + 1))
    assert st.manifest("d")["current"] is None and [st.read("d", r).count() for r in ids] == list(range(1, len(ids) + 1))
    with pytest.raises(store.Refused):
        st.read("d")
    st.promote("d", "run_1")
    assert st.read("d").count() == 2


def test_store_survives_a_crash_between_its_steps(spark, tmp_path):
    st = store.Store(spark, str(tmp_path / "s"))
    st.publish("d", "a", spark.range(3), promote=True)
    with pytest.raises(store.Refused):
        st.publish("d", "b", spark.range(4), fail_at="moved")
    again = store.Store(spark, str(tmp_path / "s"))
    assert again.read("d").count() == 3
    with pytest.raises(store.Refused, match="half published"):
        again.publish("d", "b", spark.range(4))
    again.discard("d", "b")
    assert again.publish("d", "b", spark.range(4)) and again.read("d").count() == 3 and again.read("d", "b").count() == 4
    with pytest.raises(store.Refused):
        again.discard("d", "a")
    # a manifest cut short is passed over, and its number is not used again
    (tmp_path / "s" / "d" / "_manifest" / "0000000099.json").write_text('{"current": "b", "ru')
    assert again.read("d").count() == 3
    again.promote("d", "b")
    assert again.read("d").count() == 4 and (tmp_path / "s" / "d" / "_manifest" / "0000000100.json").exists()


def test_run_guard_compares_versions_and_rows(spark, tmp_path):
    st = store.Store(spark, str(tmp_path / "s"))
    st.publish("d", "a", spark.range(3), versions={"rules": "1"})
    assert st.published("d", "a", {"rules": "1"}) and not st.published("d", "other")
    with pytest.raises(store.Refused):
        st.publish("d", "a", spark.range(3), versions={"rules": "2"})
    spark.range(2).write.mode("append").parquet(str(tmp_path / "s" / "d" / "v=a"))
    with pytest.raises(store.Refused, match="5 rows"):
        st.published("d", "a")
    st.publish("e", "a", spark.range(3))
    one = store.freeze(st, "e", "a", ["id"])
    assert store.freeze(st, "e", "a", ["id"]) == one and one["rows"] == 3
    with pytest.raises(store.Refused):
        store.freeze(st, "e", "z", ["id"])


def test_partition_replacement_and_merge(spark, tmp_path):
    p = str(tmp_path / "d")
    store.replace_partitions(spark.createDataFrame([(1, "a"), (2, "b")], "x int, day string"), p, ["day"])
    store.replace_partitions(spark.createDataFrame([(9, "b")], "x int, day string"), p, ["day"])
    assert sorted(r.x for r in spark.read.parquet(p).collect()) == [1, 9]
    a, b = spark.createDataFrame([(1, "o"), (2, "o")], "k int, v string"), spark.createDataFrame([(2, "n"), (3, "n")], "k int, v string")
    assert sorted(map(tuple, store.upsert(a, b, ["k"]).collect())) == [(1, "o"), (2, "n"), (3, "n")]
    assert [r.k for r in store.append_new(b, a, ["k"]).collect()] == [3]


def test_schemas(spark):
    assert same_shape(SCHEMAS["rights_holders"], spark.createDataFrame([], SCHEMAS["rights_holders"]).schema)
    assert not SCHEMAS["listens"]["listen_hash"].nullable and SCHEMAS["listens"]["release_name"].nullable


def test_streaming_days(spark, tmp_path):
    src = spark.createDataFrame([("h1", "m", "2026-06-01 01:00:00"), ("h1", "m", "2026-06-01 01:00:00"), ("h2", "m", "2026-06-01 02:00:00"), ("h3", "m", "2026-06-02 02:00:00"), ("h4", "z", "2026-06-20 00:00:00")], "listen_hash string, recording_msid string, ts string").select("listen_hash", "recording_msid", F.to_timestamp("ts").alias("listened_at"))
    src.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(src.schema).parquet(str(tmp_path / "in"))
    q = recording_days(stream).writeStream.format("memory").queryName("days_out").outputMode("append").option("checkpointLocation", str(tmp_path / "cp")).start()
    q.processAllAvailable()
    q.stop()
    assert sorted((r.recording_msid, str(r.listen_date), r.streams) for r in spark.sql("select * from days_out").collect()) == [("m", "2026-06-01", 2), ("m", "2026-06-02", 1)]
