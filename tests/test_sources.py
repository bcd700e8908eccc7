import gzip
import json
import os
import time

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadenza import storage
from cadenza.sources import columns, files, manifests, observations
from cadenza.streaming import inventory


def test_scan_and_digest(spark, tmp_path):
    for name in ("a/x.MP4", "a/deep/y.mov", "b/z.mkv", "b/skip.txt"):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(name.encode() * 10)
    got = files.scan(spark, f"file://{tmp_path}", ["a", "b"]).collect()
    assert [r.relative_path for r in got] == ["a/deep/y.mov", "a/x.MP4", "b/z.mkv"] and got[0].bytes == 120
    rows = spark.createDataFrame([(bytearray(b"abc"),), (None,)], "c binary").select(files.edge_digest(F.col("c")).alias("d")).collect()
    assert rows[0].d == files.digest_bytes(b"abc") and rows[1].d is None
    assert files.digest_bytes(b"x" * (files.EDGE + 1)) != files.digest_bytes(b"x" * (files.EDGE + 2))


def test_probe(spark):
    good = {"streams": [{"codec_type": "audio"}, {"codec_type": "video", "width": 1920, "height": 1080, "avg_frame_rate": "", "r_frame_rate": "100/1"}], "format": {"duration": "2.5"}}
    rows = files.probed(spark.createDataFrame([(json.dumps(good),), ("{broken",)], "j string"), "j").collect()
    assert rows[0].probe_ok and rows[0].is_1080p100 and rows[0].fps == 100.0 and len(rows[0].audio) == 1
    assert not rows[1].probe_ok and rows[1].probe_error


def test_array_cache(spark, tmp_path):
    for source, n in (("s1", 40_000), ("s2", 3)):
        (tmp_path / source).mkdir()
        np.save(tmp_path / source / "score.npy", np.where(np.arange(n) % 2, np.nan, np.arange(n)).astype(np.float32))
        np.save(tmp_path / source / "flag.npy", np.arange(n) % 3 == 0)
        np.save(tmp_path / source / "eye.npy", np.arange(n * 2, dtype=np.float32).reshape(n, 2))
    kinds = {"score": T.DoubleType(), "flag": T.BooleanType(), "eye": T.ArrayType(T.DoubleType())}
    df = columns.read_cache(spark, f"file://{tmp_path}", ["s1", "s2"], kinds)
    assert df.groupBy("source_id").count().orderBy("source_id").collect() == [("s1", 40_000), ("s2", 3)]
    row = df.where("source_id = 's1' and idx = 30001").first()
    assert row.score is None and row.flag == (30001 % 3 == 0) and row.eye == [60002.0, 60003.0]
    np.save(tmp_path / "s2" / "flag.npy", np.array([True]))
    with pytest.raises(Exception, match="differ in length"):
        columns.read_cache(spark, f"file://{tmp_path}", ["s2"], kinds).collect()


def test_manifests_and_sinks(spark, tmp_path):
    item = T.StructType.fromDDL("id string, n long")
    (tmp_path / "bare.json").write_text('[{"id": "a", "n": 1}]')
    (tmp_path / "items.json").write_text('{"summary": {}, "items": [{"id": "b", "n": 2}, {"id": "c"}]}')
    (tmp_path / "d.json").write_text('{"decisions": {"s1": "keep"}}')
    assert manifests.read_items(spark, f"file://{tmp_path}/bare.json", item).collect() == [("a", 1)]
    assert manifests.read_items(spark, f"file://{tmp_path}/items.json", item).collect() == [("b", 2), ("c", None)]
    assert manifests.read_decisions(spark, f"file://{tmp_path}/d.json").collect() == [("s1", "keep")]
    rows = spark.createDataFrame([("é", 1)], "name string, n int").coalesce(1)
    manifests.write_csv(rows, f"file://{tmp_path}/csv")
    part = next(p for p in os.listdir(tmp_path / "csv") if p.endswith(".csv"))
    assert (tmp_path / "csv" / part).read_text("utf-8-sig").splitlines() == ["name,n", "é,1"]
    manifests.write_json_lines(rows, f"file://{tmp_path}/jsonl")
    part = next(p for p in os.listdir(tmp_path / "jsonl") if p.endswith(".gz"))
    assert json.loads(gzip.open(tmp_path / "jsonl" / part, "rt").read()) == {"name": "é", "n": 1}
    manifests.write_json_document(rows, f"file://{tmp_path}/doc")
    part = next(p for p in os.listdir(tmp_path / "doc") if p.startswith("part"))
    assert json.loads((tmp_path / "doc" / part).read_text()) == [{"name": "é", "n": 1}]
    manifests.write_json_document(rows.limit(0), f"file://{tmp_path}/none")
    part = next(p for p in os.listdir(tmp_path / "none") if p.startswith("part"))
    assert json.loads((tmp_path / "none" / part).read_text()) == []
    many = spark.range(2500).select("id", F.concat(F.lit("<&"), "id").alias("v"))
    manifests.write_html_table(many, "t<", f"file://{tmp_path}/page")
    part = next(p for p in os.listdir(tmp_path / "page") if p.startswith("part"))
    page = (tmp_path / "page" / part).read_text()
    assert "<title>t&lt;</title>" in page and page.count("<tr><td>") == 2500 and "<td>&lt;&amp;2499</td>" in page
    manifests.write_json_document(many, f"file://{tmp_path}/docs")
    part = next(p for p in os.listdir(tmp_path / "docs") if p.startswith("part"))
    assert [x["id"] for x in json.loads((tmp_path / "docs" / part).read_text())] == list(range(2500))


class Fake:
    def __init__(self, n):
        self.left = n

    def get_batch_frames(self, n):
        take, self.left = min(n, self.left), self.left - min(n, self.left)
        return [0] * take

    def end(self):
        pass


def test_observations(spark):
    schema = T.StructType.fromDDL("source_id string, frame int, score double")
    sources = spark.createDataFrame([("a", "5"), ("b", "0")], "source_id string, path string")
    rows = observations.decoded(sources, lambda path: Fake(int(path)), lambda images: [{"score": 0.5} for _ in images], 2, schema).collect()
    assert [(r.source_id, r.frame) for r in rows] == [("a", i) for i in range(5)]
    seen = observations.observe(sources, lambda pdf: pd.DataFrame({"source_id": pdf.source_id, "frame": 1, "score": 1.0}), schema)
    assert seen.count() == 2


def test_incremental_inventory(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.mp4").write_bytes(b"1")
    seen = []
    run = lambda: inventory.catch_up(inventory.new_files(spark, f"file://{tmp_path}/in"), f"file://{tmp_path}/cp", lambda df: seen.append(sorted(r.path.split("/")[-1] for r in df.collect())), (".mp4",)).awaitTermination()
    run()
    (tmp_path / "in" / "b.mp4").write_bytes(b"2")
    run()
    assert [s for s in seen if s] == [["a.mp4"], ["b.mp4"]]


def test_kept_tables_leave_no_shuffle_files(spark):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    shuffled = lambda: {f for f in disk.getAllFiles().mkString("\n").split("\n") if "shuffle_" in f}
    before, setting = shuffled(), spark.conf.get(storage.CLEANUP)
    kept = storage.Scratch(spark, "test").keep(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "t")
    deadline = time.monotonic() + 30  # they go in the background
    while shuffled() - before and time.monotonic() < deadline:
        time.sleep(0.2)
    assert not shuffled() - before
    assert spark.conf.get(storage.CLEANUP) == setting
    assert kept.agg(F.sum("count")).first()[0] == 1000
