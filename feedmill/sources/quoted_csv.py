"""CSV with quoted line breaks, read by many tasks a file.

Spark's own text scan deals a file to tasks by byte ranges, cut at line breaks. A
line break inside quotes is not the end of a record, and whether a range begins
inside quotes depends on all ranges before it. So the first pass works out, for
every range, what it makes of either beginning: outside or inside quotes. Chained
along a file, these say where each range really begins. The second pass puts lines
together to records; a record belongs to the range it starts in, and the parts of
one that reaches beyond are sent there. No range is read by more than its task,
and what is shuffled is one record a border at most.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

OPTIONS = {"escape": '"', "multiLine": "true"}

# A quoted field up to its end, with whatever stands behind its closing quote, or a field without quotes.
_FIELD = r'(?>"(?:[^"]++|"")*+"[^,]*+,|(?!")[^,]*+,)*+'
_OPEN = r'"(?:[^"]++|"")*+\Z'
#: Lines that end inside quotes: those that begin outside, and those that begin inside.
_OPENS = re.compile(_FIELD + _OPEN)
_STAYS = re.compile(rf'(?:[^"]++|"")*+(?:\Z|"[^,]*+,{_FIELD}{_OPEN})')

Batches = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]
_KEY = "file string, start bigint, size bigint"
_RANGES = f"{_KEY}, out_to boolean, in_to boolean, through boolean, crlf boolean"
_PIECES = f"{_KEY}, crlf boolean, owner bigint, whole boolean, first boolean, text string"


def _lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    meta = [F.col(f"_metadata.{c}").alias(to) for c, to in (("file_path", "file"), ("file_block_start", "start"), ("file_block_length", "size"))]
    return spark.read.option("lineSep", "\n").text(paths).select(*meta, "value")


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """The rows of a batch by range; those of a range lie together."""
    keys = [batch.column(c) for c in ("file", "start", "size")]
    codes = np.stack([k.dictionary_encode().indices.to_numpy() for k in keys])
    turns = np.flatnonzero((codes[:, 1:] != codes[:, :-1]).any(axis=0)) + 1
    for lo, hi in zip([0, *turns], [*turns, batch.num_rows]):
        yield tuple(k[lo].as_py() for k in keys), batch.slice(lo, hi - lo)


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What each range makes of a beginning outside and inside quotes; lines without a quote come as nulls."""
    names = [c.split()[0] for c in _RANGES.split(", ")]
    key, state = None, {}

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([dict(zip(names, (*key, *state.values())))], pa.schema(_fields(_RANGES)))

    for batch in batches:
        if not batch.num_rows:
            continue
        for this, rows in _runs(batch):
            if this != key:
                if key is not None:
                    yield row()
                key, state = this, {"out_to": False, "in_to": True, "through": True, "crlf": rows.column("crlf")[0].as_py()}
            for line in rows.column("value").drop_null().to_pylist():
                state["out_to"], state["in_to"] = (
                    (_STAYS if inside else _OPENS).match(line) is not None for inside in (state["out_to"], state["in_to"])
                )
                state["through"] &= state["in_to"]
    if key is not None:
        yield row()


def _fields(schema: str) -> list[tuple[str, pa.DataType]]:
    kinds = {"string": pa.string(), "bigint": pa.int64(), "boolean": pa.bool_()}
    return [(name, kinds[kind]) for name, kind in (c.split() for c in schema.split(", "))]


def _chain(ranges: pd.DataFrame) -> pd.DataFrame:
    """Along one file: does a range begin inside quotes, and in which range does that record start?"""
    inside, owner, rows = False, 0, []
    ranges = ranges.sort_values("start")
    crlf = bool(ranges["crlf"].iloc[0])
    for r in ranges.itertuples():
        rows.append((r.file, r.start, r.size, inside, owner if inside else r.start, crlf))
        after = r.in_to if inside else r.out_to
        if not (inside and r.through):
            owner = r.start
        inside = after
    return pd.DataFrame(rows, columns=["file", "start", "size", "inside", "owner", "crlf"])


def _states(values: pa.Array, inside: bool) -> tuple[np.ndarray, bool]:
    """For each line, does it begin inside quotes? And does the line after the last?"""
    quoted = np.flatnonzero(pc.match_substring(values, '"').to_numpy(zero_copy_only=False))
    states, last = np.zeros(len(values), dtype=bool), 0
    for k, line in zip(quoted, values.take(pa.array(quoted)).to_pylist()):
        states[last : k + 1] = inside
        inside, last = (_STAYS if inside else _OPENS).match(line) is not None, k + 1
    states[last:] = inside
    return states, inside


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole records, and the parts of those that begin before their range or end behind it."""
    schema = pa.schema(_fields(_PIECES))
    key, inside, held, begun, first, owner, crlf = None, False, [], False, False, 0, False

    def emit(texts: pa.Array | list[str], of: int, whole: bool, firsts: list[bool]) -> pa.RecordBatch:
        texts = pa.array(texts, pa.string()) if isinstance(texts, list) else texts
        same = zip((*key, crlf, of, whole), schema.types)
        columns = [*(pa.array([value] * len(texts), kind) for value, kind in same), pa.array(firsts), texts]
        return pa.RecordBatch.from_arrays(columns, schema=schema)

    def part(closed: bool) -> Iterator[pa.RecordBatch]:
        """What is held, put out: a record of this range, or a part of one."""
        nonlocal held, first
        if held:
            whole = begun and closed
            yield emit(["\n".join(held)], key[1] if begun else owner, whole, [begun and first])
            first, held = first and not begun, []

    for batch in batches:
        if not batch.num_rows:
            continue
        for this, rows in _runs(batch):
            if this != key:
                yield from part(closed=not inside)
                key, inside = this, rows.column("inside")[0].as_py()
                owner, crlf = (rows.column(c)[0].as_py() for c in ("owner", "crlf"))
                begun, first = not inside, this[1] == 0
            values = rows.column("value")
            states, inside = _states(values, inside)
            starts = np.flatnonzero(~states)
            if not len(starts):
                held += values.to_pylist()
                continue
            # Lines before the first start go on with what is held; then every start ends a record.
            held += values.slice(0, starts[0]).to_pylist()
            yield from part(closed=True)
            begun = True
            length = np.diff(np.append(starts, len(values)))
            done = starts[:-1]
            single = done[length[:-1] == 1]
            if len(single):
                firsts = [False] * len(single)
                firsts[0] = first and single[0] == starts[0]
                yield emit(values.take(pa.array(single)), key[1], True, firsts)
            many = [k for k in np.flatnonzero(length[:-1] > 1)]
            if many:
                firsts = [first and starts[k] == starts[0] for k in many]
                texts = ["\n".join(values.slice(starts[k], length[k]).to_pylist()) for k in many]
                yield emit(texts, key[1], True, firsts)
            first = first and not len(done)
            held = values.slice(starts[-1]).to_pylist()
    yield from part(closed=not inside)


def csv_records(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``record, first``: the text of every record, and whether it is the first of its file.

    Line breaks inside quotes stay; in a file whose first line ends with a carriage
    return, that is taken off every line, as by Spark's own reader. Empty records
    are left out. A quote that is never closed takes the rest of its file.
    """
    lines = _lines(spark, paths)
    quoted = F.when(F.contains("value", F.lit('"')), F.col("value"))
    asked = lines.select("file", "start", "size", F.endswith("value", F.lit("\r")).alias("crlf"), quoted.alias("value"))
    found = asked.mapInArrow(_ranges, _RANGES)
    chained = found.groupBy("file").applyInPandas(_chain, f"{_KEY}, inside boolean, owner bigint, crlf boolean")
    # One row a scan task. A range that is unknown was cut otherwise the first time.
    told = lines.join(F.broadcast(chained), ["file", "start", "size"], "left").withColumn(
        "inside", F.coalesce("inside", F.raise_error(F.lit("the ranges of a file changed between two scans")).cast("boolean"))
    )
    parts = told.select("file", "start", "size", "inside", "owner", "crlf", "value").mapInArrow(_pieces, _PIECES)
    ordered = F.sort_array(F.collect_list(F.struct("start", "text")))
    joined = parts.where("NOT whole").groupBy("file", "owner").agg(
        F.first("crlf").alias("crlf"),
        F.max("first").alias("first"),
        F.array_join(F.transform(ordered, lambda p: p["text"]), "\n").alias("text"),
    )
    columns = ["crlf", "first", "text"]
    every = parts.where("whole").select(*columns).unionByName(joined.select(*columns))
    plain = F.replace(F.col("text"), F.lit("\r\n"), F.lit("\n"))
    bare = F.when(F.col("crlf"), F.regexp_replace(plain, r"\r\z", "")).otherwise(F.col("text"))
    return every.select(bare.alias("record"), "first").where("record <> ''")


def read_quoted_csv(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """All columns of the files as text, by many tasks a file; the rows of ``multiLine`` reading, in any order.

    The files must share one header: the job stops at one that differs.
    """
    names = spark.read.options(header=True, **OPTIONS).csv(paths).columns
    quoted = ["`" + n.replace("`", "``") + "`" for n in names]
    parsed = F.from_csv("record", ", ".join(f"{n} string" for n in quoted), OPTIONS | {"lineSep": "\n"})
    rows = csv_records(spark, paths).select("first", parsed.alias("r"))
    header = F.array(*[F.col(f"r.{n}") for n in quoted])
    same = header == F.array(*[F.lit(n) for n in names])
    wrong = F.raise_error(F.lit("a CSV header differs from that of the first file")).cast("boolean")
    return rows.where(F.when(~F.col("first"), True).when(same, False).otherwise(wrong)).select("r.*")
