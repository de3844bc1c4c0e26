"""Earthquake job: each CSV to Avro and Parquet under every codec."""

from __future__ import annotations

import argparse
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from feedmill.operators import quakes
from feedmill.operators.quality import Output, manifest
from feedmill.schemas import QUAKE_AVRO
from feedmill.session import prepare, scratch_dir
from feedmill.sinks import output_name, write_parquet, writer
from feedmill.sinks.together import Step, run_jobs, write_together
from feedmill.sources import read_parquet, read_quake_csv

# The conversion matrix, one output per (format, codec) pair.
CONVERSIONS = [
    ("avro", "null"),
    ("avro", "deflate"),
    ("avro", "snappy"),
    ("parquet", "NONE"),
    ("parquet", "SNAPPY"),
    ("parquet", "GZIP"),
    ("parquet", "LZ4"),
]


def _project(rows: DataFrame, extension: str, zone: str) -> DataFrame:
    return quakes.avro_rows(rows, zone) if extension == "avro" else quakes.parquet_rows(rows)


def convert(
    spark: SparkSession,
    input_path: str,
    output_folder: str,
    extension: str,
    codec: str,
    zone: str = "UTC",
    multi_line: bool = True,
    mode: str = "errorifexists",
    split: bool = False,
) -> str:
    """One input to one output; gives the output's path."""
    prepare(spark)
    rows = _project(read_quake_csv(spark, input_path, multi_line, split), extension, zone)
    path = output_name(input_path, output_folder, codec, extension)
    return writer(extension, codec, QUAKE_AVRO, mode)(rows, path)


def convert_all(
    spark: SparkSession,
    input_paths: list[str],
    output_folder: str,
    conversions: list[tuple[str, str]] = CONVERSIONS,
    zone: str = "UTC",
    multi_line: bool = True,
    mode: str = "errorifexists",
    split: bool = False,
    jobs: int = 4,
    step: Step = lambda name, path: None,
) -> list[Output]:
    """Every input under every conversion; all outputs appear, or none does.

    A CSV is parsed once per format, into a typed Parquet copy in the shared
    scratch folder; the codecs of that format are then written from the copy,
    which is columnar and splits across tasks even when the CSV did not. At most
    ``jobs`` copies or outputs are written at a time (``sinks/together.py``).
    ``mode`` is ``errorifexists`` or ``overwrite``.
    """
    if mode not in ("error", "errorifexists", "overwrite"):
        raise ValueError(f"outputs that appear together are new or replaced whole, not {mode!r}")
    prepare(spark)
    wanted = list(dict.fromkeys((path, extension) for path in input_paths for extension, _ in conversions))
    copies = {(path, extension): scratch_dir(spark, f"quakes-{extension}") for path, extension in wanted}

    def copy(path: str, extension: str) -> Callable[[], str]:
        rows = _project(read_quake_csv(spark, path, multi_line, split), extension, zone)
        return lambda: write_parquet(rows, copies[path, extension], "SNAPPY")

    run_jobs(spark, [copy(*pair) for pair in wanted], jobs)

    def write(path: str, extension: str, codec: str) -> Callable[[str], str]:
        typed = read_parquet(spark, copies[path, extension])
        return lambda to: writer(extension, codec, QUAKE_AVRO)(typed, to)

    writes, outputs = {}, []
    for path in input_paths:
        for extension, codec in conversions:
            name = output_name(path, "", codec, extension)
            if name in writes:
                raise ValueError(f"two outputs are named {name}")
            writes[name] = write(path, extension, codec)
            outputs.append(Output("Earthquake", None, output_name(path, output_folder, codec, extension), codec, extension))
    write_together(spark, output_folder, writes, jobs, mode == "overwrite", step)
    return outputs


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--input_path", required=True, nargs="+")
    parser.add_argument("--output_path", required=True)
    parser.add_argument("--zone", default="UTC", help="zone of UTC_Date texts without an offset (Avro only)")
    parser.add_argument("--single_line", action="store_true", help="no quoted line breaks: files may be split")
    parser.add_argument("--split", action="store_true", help="large files with quoted line breaks: many tasks a file")
    parser.add_argument("--jobs", type=int, default=4, help="outputs written at a time")
    parser.add_argument("--manifest_path")
    args = parser.parse_args()
    spark = SparkSession.builder.appName("quake-convert").getOrCreate()
    outputs = convert_all(
        spark,
        args.input_path,
        args.output_path,
        zone=args.zone,
        multi_line=not args.single_line,
        split=args.split,
        jobs=args.jobs,
    )
    for output in outputs:
        print(output.path)
    if args.manifest_path:
        write_parquet(manifest(spark, outputs, "quake-convert"), args.manifest_path, mode="append")


if __name__ == "__main__":
    main()
