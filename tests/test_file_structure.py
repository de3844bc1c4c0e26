"""Rows by file structure against full reads, in ranges of many sizes, and damaged files."""

import pytest
from pyspark.errors import PySparkException

from feedmill.operators.quality import Output, manifest
from feedmill.sinks import AVRO_CODECS, PARQUET_CODECS, write_parquet
from feedmill.sources import AVRO_FORMAT, read_avro
from feedmill.sources.file_structure import file_structure


def _rows(spark, n=20000):
    return spark.range(n).selectExpr("id", "concat('row ', sha2(cast(id as string), 256)) as text")


def _avro(spark, path, codec="null", n=20000, files=3):
    _rows(spark, n).repartition(files).write.format(AVRO_FORMAT).option("compression", AVRO_CODECS[codec]).save(path)
    return path


def _one(path):
    return max((p for p in path.glob("*.avro")), key=lambda p: p.stat().st_size)


@pytest.mark.parametrize("split_mb", [256, 0.05, 0.003])
def test_every_codec_and_range_size(spark, tmp_path, split_mb):
    outputs, want = [], []
    for codec in AVRO_CODECS:
        outputs.append((_avro(spark, str(tmp_path / f"a b=c%20 {codec}.avro"), codec), "avro"))
        want.append(codec)
    for codec, name in PARQUET_CODECS.items():
        path = str(tmp_path / f"x.{codec}.parquet")
        outputs.append((write_parquet(_rows(spark).repartition(3), path, codec), "parquet"))
        want.append({"none": "uncompressed", "lz4_raw": "lz4"}.get(name, name))
    got = file_structure(spark, outputs, split_mb).collect()
    for k, codec in enumerate(want):
        of = [r for r in got if r["output"] == k]
        assert len(of) == 3 and sum(r["rows"] for r in of) == 20000
        assert {r["codec"].removesuffix("_raw") for r in of} == {codec}
        assert all(r["blocks"] >= 1 for r in of)
        sizes = {p.stat().st_size for p in (tmp_path / outputs[k][0]).glob("part-*")}
        assert {r["bytes"] for r in of} == sizes
        if split_mb == 256 and codec != "deflate":
            assert sum(r["bytes_read"] for r in of) < sum(sizes) / 10


def test_empty_frames_sub_folders_and_folders_without_files(spark, tmp_path):
    empty = _avro(spark, str(tmp_path / "empty"), n=0)
    assert [r["rows"] for r in file_structure(spark, [(empty, "avro")]).collect()] == [0] * len(list((tmp_path / "empty").glob("*.avro")))
    parts = str(tmp_path / "parts")
    _rows(spark, 100).selectExpr("*", "id % 3 as k").write.partitionBy("k").parquet(parts)
    assert sum(r["rows"] for r in file_structure(spark, [(parts, "parquet")]).collect()) == 100
    (tmp_path / "bare").mkdir()
    with pytest.raises(PySparkException, match="no files in the output"):
        manifest(spark, [Output("e", None, str(tmp_path / "bare"), "null", "avro")], "s").collect()
    with pytest.raises(ValueError, match="at least one output"):
        manifest(spark, [], "s")


def test_a_file_that_is_cut_short_or_changed_is_found(spark, tmp_path):
    def fails(name, change, message):
        path = tmp_path / name
        _avro(spark, str(path), files=1)
        file = _one(path)
        file.write_bytes(change(bytearray(file.read_bytes())))
        (path / f".{file.name}.crc").unlink()
        for split_mb in (256, 0.05):
            with pytest.raises(PySparkException, match=message):
                file_structure(spark, [(str(path), "avro")], split_mb).collect()

    def flip(data):
        data[-1] ^= 1
        return data

    fails("cut", lambda d: d[:-3], "cut short")
    fails("last_mark", flip, "damaged")
    fails("header", lambda d: d[:100], "within its header")
    fails("magic", lambda d: b"no" + d, "not an Avro container")
    fails("half", lambda d: d[: len(d) // 2], "cut short|within the block")


def test_manifest_counts_all_kinds_of_outputs(spark, tmp_path):
    avro, text = _avro(spark, str(tmp_path / "a.avro")), str(tmp_path / "lines")
    _rows(spark, 7).selectExpr("text").write.text(text)
    table = write_parquet(_rows(spark, 11), str(tmp_path / "p"))
    outputs = [
        Output("e", None, text, "none", "json"), Output("e", "batch", table, "GZIP"),
        Output("e", None, avro, "null", "avro"), Output("e", "again", table, "GZIP"),
    ]
    rows = manifest(spark, outputs, "s").collect()
    assert sorted((r["format"], r["route"], r["rows"]) for r in rows if r["route"]) == [("parquet", "again", 11), ("parquet", "batch", 11)]
    assert sorted((r["format"], r["rows"]) for r in rows if not r["route"]) == [("avro", 20000), ("json", 7)]
    assert read_avro(spark, avro).count() == 20000
