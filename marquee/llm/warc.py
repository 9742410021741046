"""WARC archives: writing records, splitting whole-file gzip streams into members, reading."""

from __future__ import annotations

import hashlib
import json
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm.common import attempt_name, filesystem, load, make_folder, octets, ship_package, slices
from marquee.session import scratch_path
from marquee.sources.tables import materialize

# Equal payloads from this size on are written once.
REVISIT_BYTES = 1000
BLOCK = 1 << 20
# Names of the format.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2000-01-01T00:00:00Z"
URI_SAFE = "".join(chr(c) for c in range(33, 127))
FILES = "file string, records long"
RECORDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def planned(pages: DataFrame, at_least: int = REVISIT_BYTES) -> DataFrame:
    """Each page's payload, its digest, and whether it is a response or revisits another page.

    Of pages with equal payloads of ``at_least`` bytes, that with the largest page_id is the
    response. A null html is an empty payload. A page without page_id can revisit but is never
    revisited, so a group without any page_id is all responses; rows that repeat the
    largest page_id are responses, too. Repeated digests are counted with a map-side combine and
    stored; joining two stored tables lets adaptive execution split a digest with many pages.
    """
    payload = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(
        F.col("page_id").cast("long"), F.col("url").cast("string"), payload.alias("payload"),
        F.sha1(F.encode(payload, "UTF-8")).alias("digest"), F.octet_length(payload).alias("size"))
    kept = rows.filter(F.col("size") >= at_least).groupBy("digest", "size").agg(
        F.max("page_id").alias("keeper"), F.count("*").alias("copies"))
    kept = materialize(
        kept.filter((F.col("copies") > 1) & F.col("keeper").isNotNull()).drop("copies"), "payloads")
    revisits = F.col("keeper").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("keeper"))
    return rows.join(kept, ["digest", "size"], "left").select(
        "page_id", "url", "payload", "digest",
        F.when(revisits, F.col("keeper")).alias("refers_to"))


def record(page_id: int | None, url: str | None, payload: bytes, digest: str,
           refers_to: int | None) -> bytes:
    """A response with its payload, or a revisit with the payload's headers alone."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    block = http + payload if refers_to is None else http
    lines = [VERSION, f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
             f"WARC-Record-ID: <urn:page:{'none' if page_id is None else page_id}>", f"WARC-Date: {DATE}",
             "Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: sha1:{digest}"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {quote(url, safe=URI_SAFE)}")
    if refers_to is not None:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write the planned pages as whole-file gzip streams, one per task; list the files.

    The list is stored, and only files it names count: what a lost task left is not read.
    """
    ship_package(pages.sparkSession)
    make_folder(folder)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, target = filesystem(f"{folder}/{attempt_name('crawl')}.warc.gz")
        out, packer, count = None, zlib.compressobj(wbits=31), 0
        for batch in batches:
            for part in slices(batch, "payload"):
                out = out or fs.open_output_stream(target, compression=None)
                columns = [part.column(c).to_pylist() for c in ("page_id", "url", "digest", "refers_to")]
                for (page_id, url, digest, refers_to), payload in zip(zip(*columns), octets(part, "payload")):
                    out.write(packer.compress(record(page_id, url, payload, digest, refers_to)))
                    count += 1
        if out:
            out.write(packer.flush())
            out.close()
            yield pa.RecordBatch.from_pydict({"file": [target], "records": [count]})

    return materialize(pages.mapInArrow(write, FILES), "archives")


def inflated(blocks: Iterator[bytes]) -> Iterator[bytes]:
    """The bytes of a gzip stream of any number of members, each read once."""
    unpack = zlib.decompressobj(wbits=31)
    for block in blocks:
        while block:
            yield unpack.decompress(block)
            if not unpack.eof:
                break
            block, unpack = unpack.unused_data, zlib.decompressobj(wbits=31)


def headers(head: bytes) -> dict[str, str]:
    """Named fields, names in lower case; the version is dropped."""
    found = {}
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        name, _, value = line.partition(":")
        found[name.strip().lower()] = value.strip()
    return found


def records(pieces: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """Whole records, with their fields, from a stream cut anywhere; one is held at a time."""
    held, need, fields = bytearray(), 0, None
    for piece in pieces:
        held += piece
        while True:
            if fields is None:
                end = held.find(b"\r\n\r\n")
                if end < 0:
                    break
                fields = headers(bytes(held[:end]))
                need = end + 4 + int(fields["content-length"]) + 4
            if len(held) < need:
                break
            yield fields, bytes(held[:need])
            del held[:need]
            fields = None
    if held:
        raise ValueError("the archive ends within a record")


def spread(files: DataFrame) -> DataFrame:
    """About a task per file, as the work is in the files and not in these few rows."""
    return files.repartition(max(1, files.count()), "file")


def normalise(files: DataFrame, folder: str) -> DataFrame:
    """Rewrite archives with every record a gzip member of its own; list the new files.

    A source is inflated once from end to end, block by block, so memory holds one record
    at most. Beside each new file lies ``.index``: a line of JSON per record with its id, type,
    offset and length, so a record can be read without what stands before it. Archives that
    already have members, or none at all, are taken as well.
    """
    ship_package(files.sparkSession)
    make_folder(folder)

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = 0
        for batch in batches:
            for source in batch.column("file").to_pylist():
                fs, path = filesystem(source)
                new_fs, target = filesystem(f"{folder}/{attempt_name('members')}-{number}.warc.gz")
                number, offset, count = number + 1, 0, 0
                with (fs.open_input_file(path) as old, new_fs.open_output_stream(target, compression=None) as new,
                      new_fs.open_output_stream(f"{target}.index", compression=None) as index):
                    for fields, whole in records(inflated(iter(lambda: old.read(BLOCK), b""))):
                        packer = zlib.compressobj(wbits=31)
                        member = packer.compress(whole) + packer.flush()
                        new.write(member)
                        index.write(json.dumps({
                            "id": fields.get("warc-record-id"), "type": fields.get("warc-type"),
                            "offset": offset, "length": len(member)}).encode() + b"\n")
                        offset, count = offset + len(member), count + 1
                yield pa.RecordBatch.from_pydict({"file": [target], "records": [count]})

    return materialize(spread(files).mapInArrow(rewrite, FILES), "members")


def member(held, offset: int, length: int) -> tuple[dict[str, str], bytes]:
    """One record's fields and block, from its own bytes alone."""
    ((fields, whole),) = records(iter([zlib.decompress(held.read_at(length, offset), wbits=31)]))
    size = int(fields["content-length"])
    return fields, whole[len(whole) - 4 - size: len(whole) - 4]


def _number(urn: str | None) -> int | None:
    name = (urn or "").strip("<>").rpartition(":")[2]
    return int(name) if name.lstrip("-").isdigit() else None


def read_archives(files: DataFrame) -> DataFrame:
    """The records of normalised archives, each by its place in the index.

    A response's payload is measured and its digest taken anew; one that differs from the
    recorded digest fails the task. A revisit states the size and digest of the payload that
    it leaves out.
    """
    ship_package(files.sparkSession)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for source in batch.column("file").to_pylist():
                fs, path = filesystem(source)
                rows = []
                with fs.open_input_file(path) as held, fs.open_input_stream(f"{path}.index", compression=None) as index:
                    for line in index.read().splitlines():
                        at = json.loads(line)
                        fields, block = member(held, at["offset"], at["length"])
                        head, _, payload = block.partition(b"\r\n\r\n")
                        digest, size = fields["warc-payload-digest"].removeprefix("sha1:"), len(payload)
                        if fields["warc-type"] == "revisit":
                            size = int(headers(head)["content-length"])
                        elif hashlib.sha1(payload).hexdigest() != digest:
                            raise ValueError(f"{path}: {at['id']} is damaged")
                        rows.append((_number(fields["warc-record-id"]), size, digest, fields["warc-type"],
                                     _number(fields.get("warc-refers-to"))))
                columns = list(zip(*rows)) or [()] * 5
                kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds)],
                    ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    return spread(files).mapInArrow(read, RECORDS)


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as whole-file streams, normalised, and read back through the index."""
    folder = scratch_path(spark, "warc")
    crawled = write_archives(planned(load(spark, sf_dir, "pages")), f"{folder}/crawl")
    return read_archives(normalise(crawled, f"{folder}/members"))


WARC_SQL = f"""
WITH p AS (
    SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS n, sha1(coalesce(html, '')) AS d FROM pages),
  k AS (
    SELECT d, n, max(page_id) AS keeper FROM p WHERE n >= {REVISIT_BYTES} GROUP BY d, n)
SELECT page_id, n AS payload_bytes, d AS payload_digest,
  CASE WHEN keeper <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN keeper <> page_id THEN keeper END AS refers_to
FROM p LEFT JOIN k USING (d, n)
"""
