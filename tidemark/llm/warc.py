"""WARC archives of pages, and a two-level capture index for looking captures up.

Records are gzip members of their own, so any one is read by its range. The index is sorted by reversed-host URL key and
cut into compressed blocks of lines; a shard of it ends with its directory, a line for each block. A lookup finds the
shard among the shards' first keys, the block in the directory by binary search, the line in the block, and then reads
just the record's range.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import struct
import uuid
import zlib
from bisect import bisect_left, bisect_right

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, fresh_dir, open_fs, small, small_batches, stored

#: A file is closed at so many bytes; a block has so many lines, an index shard about so many.
FILE_BYTES, BLOCK_LINES, SHARD_LINES = 1 << 30, 3000, 1_000_000
DATE = "2024-01-01T00:00:00Z"
ENTRY = "urlkey string, url string, page_id long, file string, at long, length long, record_type string"
_NAMESPACE = uuid.UUID("8d7f3f0e-4d1f-4c64-9a51-1f6f2f1f8a11")
_END = "<QQ8s"
_MAGIC = b"TMCDX001"


def url_key(url: Column) -> Column:
    """The host's parts from the last one on, then the rest: `https://www.a.org:80/x?q` is `org,a)/x?q`. Null stays null."""
    u = F.regexp_replace(F.lower(F.trim(url)), r"^[a-z][a-z0-9+.-]*://", "")
    host = F.regexp_replace(F.regexp_extract(u, r"^([^/?#]*)", 1), r"^(?:[^@]*@)?(?:www\d*\.)?|:\d+$|\.$", "")
    rest = F.regexp_replace(F.regexp_replace(u, r"^[^/?#]*", ""), r"#.*$", "")
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), F.when(rest == "", F.lit("/")).otherwise(rest))


def base32(hex_digest: str) -> str:
    return base64.b32encode(bytes.fromhex(hex_digest)).decode().rstrip("=")


def record_id(page_id, payload_sha1: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMESPACE, f'{page_id} {payload_sha1}')}>"


def record(kind: str, url: str | None, page_id, sha1: str, payload: bytes, refers_to=None) -> bytes:
    """A gzip member with one record. Own fields (X-...) hold what the standard has no field for: numbers of pages, the full payload's length."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head + (payload if kind == "response" else b"")
    fields = [
        ("WARC-Type", kind), ("WARC-Record-ID", record_id(page_id, sha1)), ("WARC-Date", DATE),
        ("WARC-Target-URI", json.dumps(url, ensure_ascii=False)[1:-1] if url is not None else "about:blank"), ("WARC-Payload-Digest", f"sha1:{base32(sha1)}"),
        ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block))), ("X-Payload-Length", str(len(payload))),
    ]
    if page_id is not None:
        fields.append(("X-Page-ID", str(page_id)))
    if kind == "revisit":
        fields += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Refers-To", record_id(refers_to, sha1)), ("X-Refers-To-Page-ID", str(refers_to))]
    raw = b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n" + block + b"\r\n\r\n"
    return gzip.compress(raw, 3, mtime=0)


def parse(member: bytes) -> tuple[dict[str, str], bytes]:
    """Fields and payload of a record; a response's digest is compared with its payload."""
    raw = gzip.decompress(member)
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    payload = rest[: int(fields["Content-Length"])].partition(b"\r\n\r\n")[2]
    if fields["WARC-Type"] == "response" and fields["WARC-Payload-Digest"] != f"sha1:{base32(hashlib.sha1(payload).hexdigest())}":
        raise ValueError(f"{fields['WARC-Record-ID']}: the payload isn't the one that was written")
    return fields, payload


def _writer(folder: str, ending: str):
    fs, base = open_fs(folder)
    fs.create_dir(base, recursive=True)
    name = f"{uuid.uuid4().hex}{ending}"
    return f"{folder}/{name}", fs.open_output_stream(f"{base}/{name}", compression=None)


def first_pages(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """sha1, refers_to (the smallest page_id) of payloads, of min_bytes at least, that several pages have.

    Digests are summed up before the shuffle; pages aren't brought together.
    """
    html = F.coalesce("html", F.lit(""))
    meta = pages.filter(F.octet_length(html) >= min_bytes).select("page_id", F.sha1(html.cast("binary")).alias("sha1"))
    firsts = meta.groupBy("sha1").agg(F.min("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n"))
    return cut(firsts.filter("n > 1 and refers_to is not null").select("sha1", "refers_to"))


def write_archives(pages: DataFrame, folder: str, min_bytes: int = 0) -> DataFrame:
    """Writes one record a page into archives in folder; returns their entries (ENTRY), written once.

    A task writes files of its own names, so a repeated task leaves files that no entry names.
    """
    p = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"), url_key(F.col("url")).alias("urlkey"))
    p = p.withColumn("sha1", F.sha1(F.col("html").cast("binary"))).join(small(first_pages(pages, min_bytes)), "sha1", "left")
    p = p.withColumn("refers_to", F.when(~F.col("page_id").eqNullSafe(F.col("refers_to")), F.col("refers_to")))

    def write(batches):
        name = out = None
        at = 0
        for batch in batches:
            rows = ([], [], [], [], [], [], [])
            for page, url, html, key, sha1, first in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html", "urlkey", "sha1", "refers_to"))):
                if out is None or at >= FILE_BYTES:
                    if out is not None:
                        out.close()
                    (name, out), at = _writer(folder, ".warc.gz"), 0
                kind = "response" if first is None else "revisit"
                member = record(kind, url, page, sha1, html.encode(), first)
                out.write(member)
                for to, x in zip(rows, (key, url, page, name, at, len(member), kind)):
                    to.append(x)
                at += len(member)
            yield pa.RecordBatch.from_arrays([pa.array(r, t) for r, t in zip(rows, (pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()))], [x.split()[0] for x in ENTRY.split(", ")])
        if out is not None:
            out.close()

    with small_batches(pages.sparkSession):
        return stored(p.select("page_id", "url", "html", "urlkey", "sha1", "refers_to").mapInArrow(write, ENTRY), "captures")


def write_index(entries: DataFrame, folder: str) -> DataFrame:
    """Writes the index's shards, of about SHARD_LINES captures; returns shard and first_key, one row a shard."""
    n = max(int(entries.sparkSession.conf.get("spark.sql.shuffle.partitions")), entries.count() // SHARD_LINES)

    def write(batches):
        shard = out = first = None
        lines, directory, at = [], [], 0

        def flush():
            nonlocal at, lines
            block = zlib.compress("\n".join(line for _, line in lines).encode(), 6)
            out.write(block)
            directory.append((lines[0][0], lines[-1][0], at, len(block)))
            at += len(block)
            lines = []

        for batch in batches:
            for r in batch.to_pylist():
                if out is None:
                    shard, out = _writer(folder, ".cdx")
                    first = r["urlkey"] or ""
                lines.append((r["urlkey"] or "", json.dumps([r["urlkey"], r["url"], r["page_id"], r["file"], r["at"], r["length"], r["record_type"]])))
                if len(lines) == BLOCK_LINES:
                    flush()
        if out is not None:
            if lines:
                flush()
            tail = zlib.compress(json.dumps(directory).encode())
            out.write(tail + struct.pack(_END, at, len(tail), _MAGIC))
            out.close()
            yield pa.RecordBatch.from_pydict({"shard": [shard], "first_key": [first]})

    # equal keys needn't meet in one task: a key with a third of all captures is dealt out by page_id
    dealt = entries.repartitionByRange(n, F.coalesce("urlkey", F.lit("")), "page_id").sortWithinPartitions(F.coalesce("urlkey", F.lit("")), "page_id")
    return cut(dealt.mapInArrow(write, "shard string, first_key string"))


def _directory(f) -> list[list]:
    """First key, last key, place and length of a shard's blocks, from its end."""
    size = f.size()
    at, length, magic = struct.unpack(_END, f.read_at(struct.calcsize(_END), size - struct.calcsize(_END)))
    if magic != _MAGIC:
        raise ValueError("no index shard")
    return json.loads(zlib.decompress(f.read_at(length, at)))


def read_index(shards: DataFrame) -> DataFrame:
    """All entries (ENTRY), from the index's blocks, as the shards' own directories list them."""
    n = int(shards.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def listed(batches):
        for batch in batches:
            for shard in batch.column(0).to_pylist():
                fs, path = open_fs(shard)
                with fs.open_input_file(path) as f:
                    blocks = _directory(f)
                yield pa.RecordBatch.from_arrays([pa.array([shard] * len(blocks), pa.string()), *(pa.array([b[k] for b in blocks], pa.int64()) for k in (2, 3))], ["shard", "at", "length"])

    blocks = shards.select("shard").mapInArrow(listed, "shard string, at long, length long").repartition(n, "shard", "at")

    def scan(batches):
        for batch in batches:
            for shard, at, length in zip(*(batch.column(c).to_pylist() for c in ("shard", "at", "length"))):
                fs, path = open_fs(shard)
                with fs.open_input_file(path) as f:
                    yield _entries(_lines(f, at, length))

    return blocks.mapInArrow(scan, ENTRY)


def _lines(f, at: int, length: int) -> list[list]:
    return [json.loads(x) for x in zlib.decompress(f.read_at(length, at)).decode().split("\n")]


def _entries(rows: list[list]) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "long": pa.int64()}
    columns = [x.split() for x in ENTRY.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kinds[k]) for i, (_, k) in enumerate(columns)], [c for c, _ in columns])


RECORD = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def read_records(entries: DataFrame, payload: bool = True) -> DataFrame:
    """RECORD of entries (file, at, length), read by range; a file's records are read in the order they lie in it."""
    n = int(entries.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def scan(batches):
        name = f = None
        for batch in batches:
            rows = ([], [], [], [], [], [], [])
            for file, at, length in zip(*(batch.column(c).to_pylist() for c in ("file", "at", "length"))):
                if file != name:
                    if f is not None:
                        f.close()
                    fs, path = open_fs(file)
                    name, f = file, fs.open_input_file(path)
                fields, body = parse(f.read_at(length, at))
                number = lambda k: int(fields[k]) if k in fields else None  # noqa: B023, E731
                uri = fields["WARC-Target-URI"]
                for to, x in zip(rows, (number("X-Page-ID"), None if uri == "about:blank" else json.loads(f'"{uri}"'), number("X-Payload-Length"), fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields["WARC-Type"], number("X-Refers-To-Page-ID"), body if payload else None)):
                    to.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(r, t) for r, t in zip(rows, (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()))], [x.split()[0] for x in RECORD.split(", ")])

    # stretches of a file, so that neither a long file nor a short one sets the pace
    near = F.floor(F.col("at") / (32 << 20))
    return entries.select("file", "at", "length", near.alias("near")).repartition(n, "file", "near").sortWithinPartitions("file", "at").select("file", "at", "length").mapInArrow(scan, RECORD)


def lookup(shards: DataFrame, urls: DataFrame) -> DataFrame:
    """ENTRY of all captures of the URLs in urls(url): by shard, by block, by line."""
    after = F.lead("first_key").over(Window.orderBy("first_key", "shard"))
    spans = cut(shards.select("shard", "first_key", after.alias("next_key")))
    asked = urls.select(url_key(F.col("url")).alias("key")).filter("key is not null").distinct()
    met = asked.join(small(spans), (F.col("key") >= F.col("first_key")) & (F.col("next_key").isNull() | (F.col("key") <= F.col("next_key"))))
    n = int(shards.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def find(batches):
        name = f = directory = None
        for batch in batches:
            for key, shard in zip(batch.column("key").to_pylist(), batch.column("shard").to_pylist()):
                if shard != name:
                    if f is not None:
                        f.close()
                    fs, path = open_fs(shard)
                    name, f = shard, fs.open_input_file(path)
                    directory = _directory(f)
                k, end = bisect_left(directory, key, key=lambda d: d[1]), bisect_right(directory, key, key=lambda d: d[0])
                got = [r for d in directory[k:end] for r in _lines(f, d[2], d[3]) if r[0] == key]
                if got:
                    yield _entries(got)

    return met.select("key", "shard").repartition(n, "shard").sortWithinPartitions("shard", "key").mapInArrow(find, ENTRY)


def archived(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Writes pages to archives with an index, reads all back: page_id, payload_bytes, payload_digest, record_type, refers_to.

    A null html counts as empty, a null url as about:blank; a null page_id is written without a number and is first only
    where all of its payload are null. Rows repeated with their payload's smallest page_id are responses each. An empty
    table writes nothing and gives no row. Pages of any length are written whole; pages' other columns play no part.
    """
    folder = fresh_dir(pages.sparkSession, "warc")
    shards = write_index(write_archives(pages, folder, min_bytes), folder)
    return read_records(read_index(shards), payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
