"""Readers and writers."""

import os

import pytest
from pyspark.sql import functions as F

from tessera.session import ensure_checkpoint_dir
from tessera.sources import io


def test_s3_s4_pairs_round_trip(spark, tmp):
    rows = [("a\tb", 'say "hi"'), (" x ", "y"), ("", "z"), ("two\nlines", "one\r\nmore")]
    df = spark.createDataFrame(rows, "src STRING, tgt STRING")
    path = os.path.join(tmp, "pairs")
    io.write_pairs(df, path)
    back = io.read_pairs(spark, path)
    assert sorted(map(tuple, back.collect())) == [("a\tb", 'say "hi"'), ("two\nlines", "one\r\nmore"), ("x", "y")]


def test_s5_s9_s10_manifest_and_splits(spark, tmp):
    df = spark.createDataFrame([(1, "train"), (2, "val"), (3, "test")], "id BIGINT, split STRING")
    io.write_manifest(df, os.path.join(tmp, "m"))
    assert io.read_manifest(spark, os.path.join(tmp, "m"), "id BIGINT, split STRING").count() == 3
    io.write_splits(df, os.path.join(tmp, "s"))
    assert sorted(d for d in os.listdir(os.path.join(tmp, "s")) if d.startswith("split=")) == [
        "split=test", "split=train", "split=val"]
    io.write_summary(df.agg(F.struct(F.count("id").alias("n")).alias("text")), os.path.join(tmp, "sum"))


def test_s6_list_media(spark, tmp):
    root = os.path.join(tmp, "media")
    os.makedirs(os.path.join(root, "sub"))
    for name in ("a.WAV", "sub/b.mp3", "c.txt"):
        with open(os.path.join(root, name), "wb") as f:
            f.write(b"x" * 10)
    out = io.list_media(spark, [root, os.path.join(tmp, "missing")])
    assert sorted(os.path.basename(r.path) for r in out.collect()) == ["a.WAV", "b.mp3"]
    assert {r.source_dir for r in out.collect()} == {"media"}


def test_s11_only_new(spark):
    items = spark.createDataFrame([(1,), (2,), (3,)], "id BIGINT")
    done = spark.createDataFrame([(1, 500), (2, 50)], "id BIGINT, size BIGINT")
    assert sorted(r.id for r in io.only_new(items, done, "id", "size").collect()) == [2, 3]


def test_s7_recent_requests(spark):
    df = spark.range(1000).select(F.col("id").alias("event_id"), F.col("id").alias("ts"))
    assert [r.event_id for r in io.recent_requests(df, 3).collect()] == [999, 998, 997]


def test_s3_manifest_columns_by_name(spark, tmp):
    path = os.path.join(tmp, "manifest.csv")
    with open(path, "w", encoding="utf-8") as f:
        f.write('audio_file,navi,english,speaker,split\nx.wav,"txon, ma","night, all",s1,train\ny.wav, ,empty,s1,val\n'
                'z.wav,pay,"water\nand more",s2,test\n')
    back = io.read_pairs(spark, path, sep=",")
    assert sorted(map(tuple, back.collect())) == [("pay", "water\nand more"), ("txon, ma", "night, all")]
    with open(os.path.join(tmp, "other.csv"), "w", encoding="utf-8") as f:
        f.write("a,b\n1,2\n")
    with pytest.raises(ValueError):
        io.read_pairs(spark, os.path.join(tmp, "other.csv"), sep=",")


def test_checkpoint_folder_has_to_be_shared_on_a_cluster():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())


def test_s2_one_document_read_by_several_tasks(spark, tmp):
    """Commas, brackets, quotes and escapes inside strings; nested values; keys told twice; several
    files in the order of their names; splits that cut anywhere."""
    import json
    import random

    from tessera.sources import io as sources
    rnd = random.Random(3)
    odd = ['a,b', '"q", {x', 'back\\slash, ]', 'nl\n,', '}', '[,', 'é,ì', "", '\\"', ',,']
    want = []
    for name in ("b.json", "a.json"):
        doc = {}
        for i in range(300):
            key = f"k{i}" + rnd.choice(odd)
            entry = lambda j: ({"na'vi": f"own{j}"} if rnd.random() < 0.3 else {}) | {"en": rnd.choice(odd) + str(j), "translations": [{"en": rnd.choice(odd)}], "type": "n"}
            doc[key] = rnd.choice([lambda: entry(i), lambda: [entry(i), 5, entry(-i)], lambda: [], lambda: "text, {", lambda: None, lambda: {}])()
        with open(os.path.join(tmp, name), "w") as f:
            json.dump(doc, f, indent=rnd.choice([None, 2]), ensure_ascii=False)
        rows = []
        for key, v in doc.items():
            for e in v if isinstance(v, list) else [v]:
                if isinstance(e, dict):
                    rows.append((e.get("na'vi", key), e.get("en")))
        want = rows + want if name == "a.json" else want + rows
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        df = sources.read_keyed_lexicon(spark, tmp)
        tasks = spark.read.option("lineSep", ",").text(tmp).rdd.getNumPartitions()
        got = df.orderBy("seq").select("seq", "`na'vi`", "en").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert tasks > 10
    assert [r.seq for r in got] == list(range(len(want)))
    assert [(r["na'vi"], r.en) for r in got] == want


def test_s2_empty_and_repeated_keys(spark, tmp):
    with open(os.path.join(tmp, "e.json"), "w") as f:
        f.write(' { } ')
    assert io.read_keyed_lexicon(spark, os.path.join(tmp, "e.json")).count() == 0
    with open(os.path.join(tmp, "d.json"), "w") as f:
        f.write('{"x": {"en": "1"}, "y": {"en": "2"}, "x": {"en": "3"}}')
    got = io.read_keyed_lexicon(spark, os.path.join(tmp, "d.json")).orderBy("seq").collect()
    assert [(r["na'vi"], r.en) for r in got] == [("x", "3"), ("y", "2")]
