"""WARC archives: written by tasks, read back in byte ranges.

Every record is a gzip member of its own. A reading task gets a byte range of an
archive, not a whole one: it looks for the gzip magic and takes a place for a
member only if it decodes to a WARC header and a block of the length that the
header gives; from there it follows the members one by one. A record belongs to
the range in which it starts; its end may lie in the next one. So archives of any
size are read by any number of tasks.

Equal payloads are stored once: the row with the largest id has the response,
the others are revisit records that name it, by its row, record id and url.

Archives that were written elsewhere are read too: records of any type and of
versions 0.17 to 1.1, field names in any case, folded lines, digests in base32 or
hex. They must have one record per gzip member, as the format advises. A payload
that itself holds an archive without further compression could be taken for
records by a range that begins inside it; read such archives with one range each.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Callable, Iterator
from typing import NamedTuple
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedmill.llm.common import land
from feedmill.llm.files import create, open_at, size

#: Payloads of fewer bytes are always stored in full.
LEAST_SHARED = 1000
#: Bytes of an archive that one task reads.
SPLIT = 8 * 1024 * 1024
#: A writing task begins another archive beyond this size.
ARCHIVE = 1024 * 1024 * 1024
CHUNK = 256 * 1024
MAGIC = b"\x1f\x8b\x08"
#: The first line of a record's header.
VERSION = re.compile(rb"WARC/[01]\.\d+[ \t]*\r?\n")
#: A digest is hot if one in so many of the rows that share a payload has it; there are at most as many hot ones.
HOT = 1000
#: Ways in which rows that no other row shares a join key with are dealt.
SALTS = 4096
DATE = "1970-01-01T00:00:00Z"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"


def decide(pages: DataFrame, key: str = "page_id", payload: str = "html", least: int = LEAST_SHARED) -> DataFrame:
    """``page_id, url, body, digest, refers_to, refers_url`` for every row; ``refers_to`` is null for responses.

    A null payload is empty. Of rows with equal payloads of at least ``least``
    bytes, all that share the largest id are responses; rows with a smaller or a
    null id refer to it. Groups without any id are responses. ``refers_url`` is
    the response's url (the greatest, if its rows differ in it).

    Digests, ids and urls are grouped, with partial aggregation. Bodies then meet
    the digests that rows share: the hot ones, at most ``HOT`` by their
    definition, by broadcast, so that a payload that a third of the rows share
    stays where it is; the others in a join. Rows that cannot meet any
    digest there (short, or hot) are dealt over its tasks.
    """
    body = F.coalesce(F.col(f"`{payload}`"), F.lit("")).cast("binary")
    url = F.col("url") if "url" in pages.columns else F.lit(None)
    rows = pages.select(F.col(f"`{key}`").cast("bigint").alias("page_id"), url.cast("string").alias("url"), body.alias("body"))
    rows = rows.withColumn("digest", F.sha1("body"))
    large = F.octet_length("body") >= least
    response = F.max(F.struct("page_id", "url"))  # a null id is less than any
    shared = land(
        rows.where(large)
        .groupBy("digest")
        .agg(response.alias("to"), F.count(F.lit(1)).alias("n"))
        .where("n > 1 AND to.page_id IS NOT NULL"),
        "warc-shared",
    )
    total = shared.agg(F.sum("n")).first()[0] or 0
    hot = F.col("n") * HOT >= total
    many = shared.where(hot).select(F.col("digest").alias("hot"), F.col("to").alias("hot_to"))
    few = shared.where(~hot).select(F.col("digest").alias("met"), F.col("to").alias("met_to"))
    dealt = F.concat(F.lit("-"), F.pmod(F.xxhash64("page_id", "url", F.spark_partition_id()), F.lit(SALTS)).cast("string"))
    joined = (
        rows.withColumn("digest_if_large", F.when(large, F.col("digest")))
        .join(F.broadcast(many), F.col("digest_if_large") == F.col("hot"), "left")
        .withColumn("meets", F.when(F.col("hot").isNull(), F.col("digest_if_large")))
        .withColumn("meets", F.coalesce("meets", dealt))
        .join(few, F.col("meets") == F.col("met"), "left")
        .withColumn("to", F.coalesce("hot_to", "met_to"))
    )
    revisits = F.col("to").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("to.page_id"))
    return joined.select(
        "page_id",
        "url",
        "body",
        "digest",
        F.when(revisits, F.col("to.page_id")).alias("refers_to"),
        F.when(revisits, F.col("to.url")).alias("refers_url"),
    )


def _uri(url: str) -> str:
    return quote(url, safe="%/:=&?~#+!$,;@()*[]" + chr(39))


def response_id(page_id: int | None, url: str | None, digest: str) -> str:
    """The id of a response record, the same from run to run. Rows that repeat in all three are one capture."""
    if page_id is None:
        return f"<urn:uuid:{uuid.uuid4()}>"
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {digest} {url or str()}')}>"


def record(
    page_id: int | None, url: str | None, body: bytes, digest: str, refers_to: int | None, refers_url: str | None = None
) -> bytes:
    """One record as a gzip member. A null id has no X-Row-Id field; a url is percent-encoded where it must be."""
    revisit = refers_to is not None
    number = f"<urn:uuid:{uuid.uuid4()}>" if revisit else response_id(page_id, url, digest)
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {number}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}",
        f"X-Payload-Length: {len(body)}",
        "Content-Type: application/http; msgtype=response",
    ]
    if page_id is not None:
        head.append(f"X-Row-Id: {page_id}")
    if url:
        head.append(f"WARC-Target-URI: {_uri(url)}")
    block = HTTP % len(body)
    if revisit:
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head.append(f"WARC-Refers-To: {response_id(refers_to, refers_url, digest)}")
        head.append(f"WARC-Refers-To-Date: {DATE}")
        if refers_url:
            head.append(f"WARC-Refers-To-Target-URI: {_uri(refers_url)}")
        head.append(f"X-Refers-To-Row: {refers_to}")
    else:
        block += body
    head.append(f"Content-Length: {len(block)}")
    whole = "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(whole) + packer.flush()


def _write(folder: str, archive: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, path, written, records, done = None, "", 0, 0, []
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "body", "digest", "refers_to", "refers_url"))):
                if out is None:
                    # An attempt that fails leaves a file that no listing names.
                    path = f"{folder}/{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.gz"
                    out, written, records = create(path), 0, 0
                member = record(*row)
                out.write(member)
                written, records = written + len(member), records + 1
                if written >= archive:
                    out.close()
                    done.append((path, written, records))
                    out = None
        if out is not None:
            out.close()
            done.append((path, written, records))
        names = ["path", "bytes", "records"]
        kinds = [pa.string(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], k) for i, k in enumerate(kinds)], names)

    return run


def write(decided: DataFrame, folder: str, archive: int = ARCHIVE) -> DataFrame:
    """Archives of all rows in ``folder``; their listing, one row per archive, which Spark commits whole."""
    return land(decided.mapInArrow(_write(folder, archive), "path string, bytes bigint, records bigint"), "warc-listing")


class _Range:
    """The bytes of a file from a place on, read as they are needed."""

    def __init__(self, path: str, at: int) -> None:
        self._file = open_at(path)
        self._file.seek(at)
        self.at = at  # of the first byte in ``data``
        self.data = bytearray()

    def more(self) -> bool:
        chunk = self._file.read(CHUNK)
        self.data += chunk
        return bool(chunk)

    def skip(self, n: int) -> None:
        del self.data[:n]
        self.at += n

    def close(self) -> None:
        self._file.close()


class Damaged(ValueError):
    """Bytes that are no record, or a record that differs from what its header says."""


def _fields(raw: bytes) -> tuple[dict[str, str], int]:
    """Header fields by their name in lower case, and where the block begins.

    Blanks around a value do not count; a line that begins with a blank goes on with the one before.
    """
    version = VERSION.match(raw)
    end = re.compile(rb"\r?\n\r?\n").search(raw, version.end() - 2) if version else None
    if end is None:
        raise Damaged("a member does not begin with a record's header")
    fields: dict[str, str] = {}
    name = ""
    for line in raw[version.end() : end.start()].decode("utf-8", "replace").splitlines():
        if line[:1] in (" ", "\t"):
            if name:
                fields[name] += " " + line.strip()
            continue
        name, colon, value = line.partition(":")
        name = name.strip().lower()
        if not colon or not name:
            raise Damaged("a header line without a field name")
        fields[name] = value.strip()
    if not {"warc-type", "content-length"} <= fields.keys() or not fields["content-length"].isdecimal():
        raise Damaged("a header without a type or a length")
    return fields, end.end()


def _is_record(source: _Range, i: int) -> bool:
    """Does a member at ``data[i]`` decode to a whole header, and a block of just the length that this gives?

    Only the header is held; of the block the bytes are counted.
    """
    unpacker, start, head, size, after = zlib.decompressobj(31), i, b"", 0, None
    while not unpacker.eof:
        if start >= len(source.data) and not source.more():
            return False
        part = source.data[start : start + CHUNK]
        start += len(part)
        try:
            out = unpacker.decompress(part)
        except zlib.error:
            return False
        size += len(out)
        if after is None:
            head += out
            if not VERSION.match(head) and len(head) >= 64:
                return False
            if unpacker.eof or re.search(rb"\n\r?\n", head):
                try:
                    fields, begin = _fields(head)
                except Damaged:
                    return False
                after, head = begin + int(fields["content-length"]), b""
    return after is not None and after <= size <= after + 4


def _member(source: _Range) -> bytes:
    """The member at the front, decoded whole; the source stands behind it afterwards."""
    unpacker, parts = zlib.decompressobj(31), []
    while not unpacker.eof:
        if not source.data and not source.more():
            raise EOFError("an archive ends inside a record")
        parts.append(unpacker.decompress(source.data))
        source.skip(len(source.data) - len(unpacker.unused_data))
    return b"".join(parts)


def records(path: str, start: int, end: int) -> Iterator[tuple[int, bytes]]:
    """The records that start in ``[start, end)``, each with its place."""
    source = _Range(path, start)
    try:
        while True:  # find the first member that starts here
            i = source.data.find(MAGIC)
            while i < 0:
                kept = max(0, len(source.data) - (len(MAGIC) - 1))
                source.skip(kept)
                if source.at >= end or not source.more():
                    return
                i = source.data.find(MAGIC)
            if source.at + i >= end:
                return
            if _is_record(source, i):
                source.skip(i)
                break
            source.skip(i + 1)
        while source.at < end:
            if not source.data and not source.more():
                return
            at = source.at
            yield at, _member(source)
    finally:
        source.close()


class Record(NamedTuple):
    """What is told of a record. Fields that it does not have are None."""

    page_id: int | None
    payload_bytes: int | None
    payload_digest: str | None
    record_type: str
    refers_to: int | None
    record_id: str | None
    target_uri: str | None
    refers_to_record: str | None
    #: Does the payload have the digest and length that the header gives? None if the header gives no SHA-1.
    intact: bool | None


KINDS = {
    "page_id": pa.int64(),
    "payload_bytes": pa.int64(),
    "payload_digest": pa.string(),
    "record_type": pa.string(),
    "refers_to": pa.int64(),
    "record_id": pa.string(),
    "target_uri": pa.string(),
    "refers_to_record": pa.string(),
    "intact": pa.bool_(),
}


def _sha1(value: str | None) -> str | None:
    """The bare lower-case hex of a labelled SHA-1 digest in base32 or hex; None for all else."""
    label, _, digest = (value or "").partition(":")
    if label.lower() not in ("sha1", "sha-1"):
        return None
    try:
        raw = base64.b32decode(digest.upper()) if len(digest) == 32 else bytes.fromhex(digest)
    except ValueError:
        return None
    return raw.hex() if len(raw) == 20 else None


def _whole(value: str | None) -> int | None:
    return int(value) if value is not None and re.fullmatch(r"-?\d+", value, re.ASCII) else None


def parse(raw: bytes) -> Record:
    """What a record says of itself.

    The payload is what follows the HTTP header in a block of type application/http,
    the whole block otherwise. Its length and digest are worked out, but those of a
    revisit, which holds no payload, come from its header.
    """
    fields, begin = _fields(raw)
    size = int(fields["content-length"])
    block = raw[begin : begin + size]
    if len(block) < size or raw[begin + size :].strip(b"\r\n"):
        raise Damaged("a block is not as long as its header says")
    kind, given = fields["warc-type"].lower(), _sha1(fields.get("warc-payload-digest"))
    length, intact = _whole(fields.get("x-payload-length")), None
    digest = given
    if kind != "revisit":
        if fields.get("content-type", "").lower().startswith("application/http"):
            parts = re.split(rb"\r?\n\r?\n", block, maxsplit=1)
            block = parts[1] if len(parts) > 1 else b""
        digest = hashlib.sha1(block, usedforsecurity=False).hexdigest()
        if given is not None:
            intact = digest == given and length in (None, len(block))
        length = len(block)
    return Record(
        _whole(fields.get("x-row-id")),
        length,
        digest,
        kind,
        _whole(fields.get("x-refers-to-row")),
        fields.get("warc-record-id"),
        fields.get("warc-target-uri"),
        fields.get("warc-refers-to"),
        intact,
    )


def _read(strict: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start, end in zip(*(batch.column(c).to_pylist() for c in ("path", "start", "end"))):
                rows = [parse(raw) for _, raw in records(path, start, end)]
                if strict and any(row.intact is False for row in rows):
                    raise Damaged("a payload differs from its digest")
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(KINDS.values())], list(KINDS))

    return run


def splits(listing: DataFrame, split: int = SPLIT) -> DataFrame:
    starts = F.explode(F.sequence(F.lit(0), F.col("bytes") - 1, F.lit(split).cast("bigint")))
    ranges = listing.where("bytes > 0").select("path", "bytes", starts.alias("start"))
    return ranges.select("path", "start", F.least(F.col("start") + split, F.col("bytes")).alias("end"))


def read(listing: DataFrame, split: int = SPLIT, strict: bool = True) -> DataFrame:
    """All records of the listed archives, a row with the fields of ``Record`` each.

    Where ``strict`` is off, a payload that differs from its digest does not stop the job but has ``intact`` false.
    """
    ranges = splits(listing, split)
    tasks = max(1, ranges.count())
    # One range a task, up to what a scheduler takes well; dealt round, as ranges are of one size.
    return ranges.repartition(min(tasks, 20_000)).mapInArrow(
        _read(strict),
        "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, "
        "record_id string, target_uri string, refers_to_record string, intact boolean",
    )


def listing_of(spark, paths: list[str]) -> DataFrame:
    """A listing of archives that were written elsewhere."""
    return spark.createDataFrame([(p, size(p), None) for p in paths], "path string, bytes bigint, records bigint")
