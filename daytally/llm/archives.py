"""WARC archives with a two-level capture index.

Records are gzip members of their own, so one can be read by its offset and length. Captures are
sorted by reversed-host URL key (``org,example,blog)/en/7``) and page_id; their index lines go
into compressed blocks of ``BLOCK`` lines, and each index file ends with a sparse directory: the first
line's key, offset and length of every block. A lookup finds the file by the files' first keys, the
block by binary search in that file's directory, reads the block's bytes, and then reads the
record's bytes from the archive. Nothing else of the files is read.

Records with equal payloads of at least ``SHARED`` bytes are stored once: the one with the largest
page_id is the response, the others are revisits that name it.

Files go to a folder that all executors reach, under names that no other attempt of a task
uses; only files that a finished task has reported are ever read, so a repeated or lost task does no
harm. The list of index files (one per partition, whatever the number of captures) is all that the
driver holds.

Defined cases: null html is an empty payload; a null url has the empty key; a null page_id sorts first,
and such a record revisits a copy that has an id; rows that share page_id and html are responses
alike; repeated rows give a record each; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
import zlib
from bisect import bisect_right
from collections import OrderedDict
from collections.abc import Iterator
from urllib.parse import quote, urlsplit

import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import Store, table

SHARED = 1000
BLOCK = 500
LEVEL = 5
NO_ID = -(2 ** 63)
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def filesystem(path: str):
    """The Arrow file system and path of a folder's address."""
    return arrow_fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


SAFE = ":/?#[]@!$&()*+,;=%~"


def url_key(url: str | None) -> str:
    """Host labels reversed, then path and query, in ASCII without white space; scheme, port, user,
    ``www`` and fragment don't count."""
    try:
        parts = urlsplit((url or "").strip())
        host = (parts.hostname or "").removeprefix("www.")
    except ValueError:
        host = ""
    if not host:
        return quote(url or "", safe=SAFE)
    query = f"?{parts.query}" if parts.query else ""
    return quote(f"{','.join(reversed(host.split('.')))}){parts.path or '/'}{query}", safe=SAFE)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, first: int | None, revisit: bool) -> bytes:
    """One WARC record as a gzip member."""
    def name(of: int | None) -> str:
        return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{of}/{digest}')}>"

    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {name(page_id)}", f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {quote(url or '', safe=SAFE)}",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}",
        "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}",
    ]
    if page_id is not None:
        head.append(f"X-Page-Id: {page_id}")
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {name(first)}", f"X-Refers-To-Page-Id: {first}"]
    pack = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return pack.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + pack.flush()


def parse(member: bytes) -> dict:
    """What a record says of its page; the digest of a response is taken from its payload."""
    data = zlib.decompress(member, 31)
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    revisit = fields["WARC-Type"] == "revisit"
    said = dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])
    digest = base64.b32decode(fields["WARC-Payload-Digest"].split(":")[1]).hex()
    if not revisit and (hashlib.sha1(payload).hexdigest() != digest or len(payload) != int(said["Content-Length"])):
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    return {
        "page_id": int(fields["X-Page-Id"]) if "X-Page-Id" in fields else None, "payload_bytes": int(said["Content-Length"]),
        "payload_digest": digest, "record_type": fields["WARC-Type"],
        "refers_to": int(fields["X-Refers-To-Page-Id"]) if revisit else None, "payload": None if revisit else payload,
    }


#: Bytes of records that one task looks up, and the least it is worth a task while cores are idle.
READ_BYTES, LEAST_READ = 32 << 20, 1 << 20
CAPTURES = "key string, page_id long, file string, offset long, length long"


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Writes a record per row of ``pages`` (page_id, url, html) and returns where they are: key,
    page_id, file, offset, length. The result has to be stored; computing it writes files."""
    html = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", html.alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload")).withColumn("shared", F.octet_length("payload") >= SHARED)
    owners = rows.where("shared").groupBy("digest").agg(F.max("page_id").alias("first"), F.count("*").alias("n"))
    owners = owners.where("n > 1 and first is not null").select(F.col("digest").alias("of"), "first")
    joined = rows.join(owners, (rows["digest"] == owners["of"]) & rows["shared"], "left").select(
        "page_id", "url", "payload", "digest", "first",
        F.coalesce(F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first")), F.lit(False)).alias("revisit"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = filesystem(folder)
        name, at, out = f"{uuid.uuid4().hex}.warc.gz", 0, None
        for batch in batches:
            lines = []
            for x in batch.to_pylist():
                if out is None:
                    out = system.open_output_stream(f"{root}/{name}", compression=None)
                member = record(x["page_id"], x["url"], x["payload"], x["digest"], x["first"], x["revisit"])
                out.write(member)
                lines.append((url_key(x["url"]), x["page_id"], name, at, len(member)))
                at += len(member)
            yield from _table(lines)
        if out is not None:
            out.close()

    return joined.mapInArrow(write, CAPTURES)


def _table(lines: list[tuple]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
    names = ["key", "page_id", "file", "offset", "length"]
    if lines:
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*lines), kinds)], names)


def _order(key: str, page_id: int | None) -> tuple[bytes, int]:
    return (key or "").encode(), NO_ID if page_id is None else page_id


def write_index(captures: DataFrame, folder: str) -> DataFrame:
    """Writes the index of ``captures`` and returns its files: file, key, page_id (the first line's).
    The result has to be stored. Keys with very many captures are split by page_id."""
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = filesystem(folder)
        name, out, at, held, directory, first = f"{uuid.uuid4().hex}.idx", None, 0, [], [], None

        def flush():
            nonlocal at
            packed = zlib.compress("\n".join("\t".join(x) for x in held).encode(), 6)
            key, page = held[0][:2]
            directory.append("\t".join((key, page, str(at), str(len(packed)))))
            out.write(packed)
            at += len(packed)
            held.clear()

        for batch in batches:
            for x in batch.to_pylist():
                if out is None:
                    out, first = system.open_output_stream(f"{root}/{name}", compression=None), (x["key"], x["page_id"])
                page = "" if x["page_id"] is None else str(x["page_id"])
                held.append((x["key"], page, x["file"], str(x["offset"]), str(x["length"])))
                if len(held) == BLOCK:
                    flush()
        if out is not None:
            if held:
                flush()
            packed = zlib.compress("\n".join(directory).encode(), 6)
            out.write(packed + struct.pack("<qq", at, len(packed)))
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([first[0]]), pa.array([first[1]], pa.int64())], ["file", "key", "page_id"])

    ordered = captures.repartitionByRange("key", "page_id").sortWithinPartitions("key", "page_id", "file", "offset")
    return ordered.mapInArrow(write, "file string, key string, page_id long")


class Reader:
    """Range reads of index blocks and records, with the latest files and blocks kept at hand."""

    KEPT = 64

    def __init__(self, folder: str, files: list[tuple[tuple[bytes, int], str]]):
        self.system, self.root = filesystem(folder)
        self.files, self.firsts = [f for _, f in files], [k for k, _ in files]
        self.held: OrderedDict = OrderedDict()

    def _keep(self, key, make):
        if key not in self.held:
            self.held[key] = make()
            if len(self.held) > self.KEPT:
                self.held.popitem(last=False)
        self.held.move_to_end(key)
        return self.held[key]

    def read(self, name: str, offset: int, length: int) -> bytes:
        file = self._keep(name, lambda: self.system.open_input_file(f"{self.root}/{name}"))
        return file.read_at(length, offset)

    def _directory(self, name: str) -> tuple[list, list]:
        def make():
            size = self._keep(name, lambda: self.system.open_input_file(f"{self.root}/{name}")).size()
            at, length = struct.unpack("<qq", self.read(name, size - 16, 16))
            rows = [x.split("\t") for x in zlib.decompress(self.read(name, at, length)).decode().split("\n")]
            return [_line_order(r) for r in rows], [(int(r[2]), int(r[3])) for r in rows]
        return self._keep((name,), make)

    def _block(self, name: str, at: tuple[int, int]) -> list[list[str]]:
        return self._keep((name, at), lambda: [x.split("\t") for x in zlib.decompress(self.read(name, *at)).decode().split("\n")])

    def captures(self, key: str, page_id: int | None, whole_key: bool) -> Iterator[list[str]]:
        """Index lines with the key, and with the page_id unless ``whole_key``."""
        low = (key.encode(), NO_ID) if whole_key else _order(key, page_id)
        for f in range(max(0, bisect_left_pair(self.firsts, low) - 1), len(self.files)):
            keys, places = self._directory(self.files[f])
            for b in range(max(0, bisect_left_pair(keys, low) - 1), len(places)):
                for line in self._block(self.files[f], places[b]):
                    at = _line_order(line)
                    if (at[0] if whole_key else at) > (low[0] if whole_key else low):
                        return
                    if (at[0] == low[0]) if whole_key else (at == low):
                        yield line


def bisect_left_pair(firsts: list, low) -> int:
    """Number of entries below ``low``."""
    return bisect_right(firsts, (low[0], low[1] - 0.5))


def _line_order(line: list[str]) -> tuple[bytes, int]:
    return line[0].encode(), int(line[1]) if line[1] else NO_ID


FOUND = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def reading_tasks(captures: DataFrame) -> int:
    """Tasks to read the records of ``captures`` with: by the bytes to be read, not by the size of the keys.
    Small amounts are spread over all cores."""
    total = captures.agg(F.sum("length")).first()[0] or 0
    cores = captures.sparkSession.sparkContext.defaultParallelism
    return max(1, -(-total // READ_BYTES), min(cores, total // LEAST_READ))


def lookup(queries: DataFrame, folder: str, files: DataFrame, whole_key: bool = True, tasks: int | None = None) -> DataFrame:
    """Records of ``queries`` (key, and page_id unless ``whole_key``), read through the index. Queries are
    sorted by range like the index, so that a task needs few files of it; ``tasks`` (see
    ``reading_tasks``) is the number of ranges, which Spark else takes from the size of the queries."""
    listed = sorted((_order(r["key"], r["page_id"]), r["file"]) for r in files.collect())

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(folder, listed)
        for batch in batches:
            rows = []
            for x in batch.to_pylist():
                for _, _, file, offset, length in reader.captures(x["key"], x.get("page_id"), whole_key):
                    rows.append(parse(reader.read(file, int(offset), int(length))))
            names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], k) for n, k in zip(names, kinds)], names)

    by = ["key"] if whole_key else ["key", "page_id"]
    ranges = [tasks, *by] if tasks else by
    return queries.select(*by).distinct().repartitionByRange(*ranges).sortWithinPartitions(*by).mapInArrow(read, FOUND)


def archive(pages: DataFrame, store: Store) -> tuple[DataFrame, DataFrame]:
    """Writes archives and index of ``pages`` to the store's folder: captures and index files."""
    captures = store.put(write_archives(pages, store.root), "captures")
    return captures, store.put(write_index(captures, store.root), "index")


def op7_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = Store(spark, "archives")
    captures, files = archive(table(spark, sf_dir, "pages"), store)
    return lookup(captures, store.root, files, whole_key=False, tasks=reading_tasks(captures))


OP7_SQL = f"""
with p as (select page_id, coalesce(html, '') as html, octet_length(encode(coalesce(html, ''))) as n from pages),
d as (select page_id, n, sha1(html) as digest from p),
f as (select digest, max(page_id) as first from d where n >= {SHARED} group by digest)
select d.page_id, cast(d.n as bigint) as payload_bytes, d.digest as payload_digest,
       case when f.first is not null and d.page_id is distinct from f.first then 'revisit' else 'response' end as record_type,
       case when d.page_id is distinct from f.first then f.first end as refers_to
from d left join f on d.digest = f.digest and d.n >= {SHARED}
"""
