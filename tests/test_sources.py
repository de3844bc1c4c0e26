"""Line ends, headers and stored types."""

import pyarrow.parquet as pq
import pytest

from feedmill.schemas import QUAKE_COLUMNS
from feedmill.sinks import write_parquet
from feedmill.sources import read_lines, read_quake_csv


def test_a_carriage_return_does_not_end_a_line(spark, tmp_path):
    (tmp_path / "a.json").write_bytes(b'{"a":\r1}\r\n{"a": 2}\n')
    assert [r.value for r in read_lines(spark, str(tmp_path)).collect()] == ['{"a":\r1}\r', '{"a": 2}']


def test_files_with_another_header_stop_the_job(spark, tmp_path):
    for name, columns in (("a.csv", QUAKE_COLUMNS), ("b.csv", QUAKE_COLUMNS[::-1])):
        (tmp_path / name).write_text(",".join(columns) + "\n" + ",".join("x" for _ in columns) + "\n")
    with pytest.raises(Exception, match="CSV header"):
        read_quake_csv(spark, str(tmp_path)).collect()


def test_instants_are_stored_as_milliseconds_in_utc(spark, tmp_path):
    rows = spark.sql("SELECT timestamp'2025-07-04 04:03:55.123 UTC' AS at")
    write_parquet(rows, str(tmp_path / "out"), "SNAPPY")
    (part,) = (tmp_path / "out").glob("*.parquet")
    file = pq.ParquetFile(part)
    assert str(file.schema_arrow.field("at").type) == "timestamp[ms, tz=UTC]"
    assert file.metadata.row_group(0).column(0).statistics.has_min_max
