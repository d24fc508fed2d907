"""WARC archives with a two-level capture index.

Archives are WARC 1.1, a gzip member for each record, written by tasks into the shared folder under names of their own
attempt; a manifest names what was written, so what a lost attempt leaves behind is never read. Equal payloads of at
least ``least`` bytes are stored once: the record of the smallest page id is a response, the others are revisits that
name its record.

The index sorts captures by their key (reversed host, then path and query) and id. Runs of at most RECORDS lines are
compressed blocks of index files; a sparse directory holds the first and last (key, id) of each block and where it lies.
A lookup is binary-searched in the directory, goes to its block's task, which reads that range once, and then on to the
ranges of the records. Blocks grow with the index so that the directory has at most about DIRECTORY entries of bounded
keys; that is what tasks are sent. Equal keys are told apart by ids, so a hot host or address spreads over blocks.

Defined cases: a null html is an empty payload, a null url an empty target with the key ``)``; very long payloads are one
record each; repeated rows are captures of their own, all responses if they hold the smallest id; a null page id is
larger than any, and payloads that only null ids hold are all responses; an empty table gives no rows. Input columns of
other names are not read.
"""

from __future__ import annotations

import bisect
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded, drop, looked_up, shared_path, table, written

#: Lines of an index block, entries of the directory, bytes of a key, of an archive, and of one read.
RECORDS, DIRECTORY, KEY, ARCHIVE, WINDOW = 3000, 1 << 16, 256, 64 << 20, 1 << 20
LEAST = 100
LEVEL = 4
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
URN = "urn:sparrowmill:page:"


def surt(url: Column) -> Column:
    """The sort key of a URL: its host's labels reversed and lower-cased, a port other than the scheme's, then path and query.

    Blanks and controls are percent-encoded; what is longer than KEY bytes ends in a digest.
    """
    plain = F.regexp_replace(F.regexp_replace(F.coalesce(url, F.lit("")), r"(?s)#.*", ""), r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    site, path = F.regexp_extract(plain, r"(?s)^([^/?]*)", 1), F.regexp_extract(plain, r"(?s)^[^/?]*(.*)$", 1)
    site = F.regexp_replace(F.lower(site), r"^.*@", "")
    host = F.regexp_extract(site, r"(?s)^(.*?)(:[0-9]*)?$", 1)
    port = F.regexp_replace(F.regexp_extract(site, r":[0-9]+$", 0), "^:(80|443)$", "")
    key = F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), port, F.lit(")"), path)
    for code in (*range(0x21), 0x7F):
        key = F.replace(key, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    head = F.substring(key, 1, (KEY - 64) // 4)
    return F.when(F.octet_length(key) > KEY, F.concat(head, F.sha2(key, 256))).otherwise(key)


def _store(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))


def _full(spark: SparkSession, path: str) -> str:
    """The path with its scheme and host, as workers need it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    home = where.getFileSystem(spark._jsc.hadoopConfiguration())
    out = home.makeQualified(where).toString()
    return out.replace("file:/", "file:///", 1) if out.startswith("file:/") and not out.startswith("file://") else out


def _line(url: str) -> str:
    """A URL in a header: bytes that would end or bend the line are percent-encoded."""
    return "".join(c if "!" <= c <= "~" else "".join(f"%{b:02X}" for b in c.encode()) for c in url)


def _member(kind: str, headers: list[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in [("WARC-Type", kind), *headers, ("Content-Length", str(len(block)))])
    pack = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return b"".join([pack.compress(b"WARC/1.1\r\n" + head.encode() + b"\r\n"), pack.compress(block), pack.compress(b"\r\n\r\n"), pack.flush()])


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """A response, or a revisit of the record of ``refers_to``, as a gzip member."""
    name = page_id if page_id is not None else f"none:{digest}"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    headers = [
        ("WARC-Record-ID", f"<{URN}{name}>"),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", _line(url or "")),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    if refers_to is None:
        return _member("response", headers, http + payload)
    return _member("revisit", [*headers, ("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<{URN}{refers_to}>")], http)


def parse(member: bytes) -> dict:
    """What a record says: its headers, and of its payload the bytes stored, their number and digest."""
    data = zlib.decompress(member, 31)
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    headers = dict(x.split(": ", 1) for x in lines)
    block = rest[: int(headers["Content-Length"])]
    if version != "WARC/1.1" or rest[len(block) :] != b"\r\n\r\n" or len(block) != int(headers["Content-Length"]):
        raise ValueError(f"a broken record of {headers.get('WARC-Record-ID')}")
    http, _, payload = block.partition(b"\r\n\r\n")
    said = dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:])
    name = headers["WARC-Record-ID"][1:-1].removeprefix(URN)
    out = {
        "page_id": None if name.startswith("none:") else int(name),
        "url": headers["WARC-Target-URI"],
        "record_type": headers["WARC-Type"],
        "payload_bytes": int(said["Content-Length"]),
        "payload_digest": headers["WARC-Payload-Digest"].removeprefix("sha256:"),
        "refers_to": None,
        "payload": None,
    }
    if out["record_type"] == "revisit":
        out["refers_to"] = int(headers["WARC-Refers-To"][1:-1].removeprefix(URN))
    else:
        out["payload"] = payload
        if len(payload) != out["payload_bytes"] or hashlib.sha256(payload).hexdigest() != out["payload_digest"]:
            raise ValueError(f"the payload of {headers['WARC-Record-ID']} is not what its header says")
    return out


class _Roll:
    """Appends to files of a folder, a new one beyond ``most`` bytes; each has a name of its own."""

    def __init__(self, root: str, kind: str, most: int, head: bytes = b"") -> None:
        self.store, self.root = _store(root)
        self.kind, self.most, self.head = kind, most, head
        self.out = None

    def add(self, data: bytes) -> tuple[str, int]:
        if self.out is None or self.at + len(data) > self.most > self.at - len(self.head) > 0:
            self.close()
            self.name = f"{uuid.uuid4().hex}.{self.kind}"
            self.out = self.store.open_output_stream(f"{self.root}/{self.name}", compression=None)
            self.out.write(self.head)
            self.at = len(self.head)
        where = self.at
        self.out.write(data)
        self.at += len(data)
        return self.name, where

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.out = None


class _Ranges:
    """Reads ranges of files of a folder; ranges that come in order share reads of WINDOW bytes."""

    def __init__(self, root: str) -> None:
        self.store, self.root = _store(root)
        self.name = None

    def read(self, name: str, offset: int, length: int) -> bytes:
        if name != self.name:
            if self.name is not None:
                self.file.close()
            self.file, self.name, self.lo, self.held = self.store.open_input_file(f"{self.root}/{name}"), name, 0, b""
        if not self.lo <= offset <= offset + length <= self.lo + len(self.held):
            self.file.seek(offset)
            self.lo, self.held = offset, self.file.read(max(length, WINDOW))
        out = self.held[offset - self.lo : offset - self.lo + length]
        if len(out) < length:
            raise OSError(f"{name} ends within a record")
        return out


CAPTURE = "page_id long, archive string, offset long, length long"


def _write(root: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        info = _member("warcinfo", [("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", DATE), ("Content-Type", "application/warc-fields")], b"software: sparrowmill\r\nformat: WARC File Format 1.1\r\n")
        roll = _Roll(root, "warc.gz", ARCHIVE, info)
        try:
            for batch in batches:
                rows = []
                html = batch.column("html")
                facts = zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "digest", "refers_to")), strict=True)
                for k, (page_id, url, digest, refers_to) in enumerate(facts):
                    data = record(page_id, url, html[k].as_py(), digest, refers_to)
                    rows.append((*roll.add(data), len(data)))
                names, offsets, lengths = zip(*rows, strict=True) if rows else ((), (), ())
                yield pa.record_batch(
                    [batch.column("key"), batch.column("page_id"), pa.array(names, pa.string()), pa.array(offsets, pa.int64()), pa.array(lengths, pa.int64())],
                    names=["key", "page_id", "archive", "offset", "length"],
                )
        finally:
            roll.close()

    return run


def _order(page_id: int | None) -> tuple[int, int]:
    """Null ids stand first, as in Spark's sort."""
    return (0, 0) if page_id is None else (1, page_id)


def _pack(root: str, most: int):
    names = ["first", "first_id", "last", "last_id", "file", "offset", "length"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roll = _Roll(root, "cdx.z", ARCHIVE)
        held: list[tuple] = []

        def flush() -> pa.RecordBatch:
            lines = "".join(f"{key} {json.dumps(rest)}\n" for key, *rest in held)
            data = zlib.compress(lines.encode(), 6)
            file, offset = roll.add(data)
            values = [held[0][0], held[0][1], held[-1][0], held[-1][1], file, offset, len(data)]
            kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
            held.clear()
            return pa.record_batch([pa.array([v], t) for v, t in zip(values, kinds, strict=True)], names=names)

        try:
            for batch in batches:
                for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    held.append(row)
                    if len(held) == most:
                        yield flush()
            if held:
                yield flush()
        finally:
            roll.close()

    return run


@dataclass
class Index:
    """Where archives and index files lie, and the directory, by key."""

    archives: str
    blocks: str
    directory: list[tuple]


def archive(pages: DataFrame, root: str, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least: int = LEAST) -> DataFrame:
    """Writes a record for each row below ``root``; returns (key, page_id, archive, offset, length), a row for each."""
    payload = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), payload.alias("html"), F.sha2(payload, 256).alias("digest"),
        surt(F.col(url_col)).alias("key"),
    )
    firsts = pages.where(F.octet_length(html_col) >= least).groupBy(F.sha2(F.col(html_col).cast("binary"), 256).alias("digest"))
    firsts = firsts.agg(F.min(F.col(id_col).cast("long")).alias("first"), F.count("*").alias("many"))
    firsts = written(firsts.where("many > 1 AND first IS NOT NULL").drop("many"), "firsts")
    judged = looked_up(rows, firsts, ["digest"], "left")
    judged = judged.withColumn("refers_to", F.when(~F.col("first").eqNullSafe(F.col("page_id")), F.col("first")))
    records = bounded(judged.select("key", "page_id", "url", "html", "digest", "refers_to")).mapInArrow(_write(root), f"key string, {CAPTURE}")
    return written(records, "manifest")


def build(captures: DataFrame, archives: str) -> Index:
    """Sorts captures into compressed blocks and keeps their directory."""
    spark = captures.sparkSession
    blocks = _full(spark, shared_path(spark, "cdx"))
    store, path = _store(blocks)
    store.create_dir(path)
    most = max(RECORDS, -(-captures.count() // DIRECTORY))
    dealt = captures.repartitionByRange("key", "page_id").sortWithinPartitions("key", "page_id", "archive", "offset")
    schema = "first string, first_id long, last string, last_id long, file string, offset long, length long"
    entries = written(dealt.mapInArrow(_pack(blocks, most), schema), "directory")
    rows = [(r.first, _order(r.first_id), r.last, _order(r.last_id), r.file, r.offset, r.length) for r in map(_Entry, entries.collect())]
    return Index(archives, blocks, sorted(rows, key=lambda r: r[:4]))


class _Entry:
    """A row by its columns' names; ``first`` and ``last`` among them."""

    def __init__(self, row) -> None:
        self.__dict__.update(row.asDict())


def _search(shipped, exact: bool):
    """Of each lookup, the blocks that may hold it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        directory = shipped.value
        firsts, lasts = [(e[0], e[1]) for e in directory], [(e[2], e[3]) for e in directory]
        for batch in batches:
            keys = batch.column("key").to_pylist()
            ids = batch.column("page_id").to_pylist() if exact else [None] * len(keys)
            rows: list[tuple] = []
            for key, page_id in zip(keys, ids, strict=True):
                low = (key, _order(page_id)) if exact else (key, (0, 0))
                high = low if exact else (key, (2, 0))
                for k in range(bisect.bisect_left(lasts, low), bisect.bisect_right(firsts, high)):
                    rows.append((k, *directory[k][4:], key, page_id))
            cols = list(zip(*rows, strict=True)) or [()] * 6
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64()]
            yield pa.record_batch([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=["block", "file", "at", "size", "key", "page_id"])

    return run


def _read_blocks(root: str, exact: bool):
    """The captures of lookups, which come by block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranges, block, lines = _Ranges(root), None, {}
        for batch in batches:
            rows: list[tuple] = []
            for number, file, at, size, key, page_id in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if number != block:
                    block, lines = number, {}
                    for line in zlib.decompress(ranges.read(file, at, size)).decode().split("\n")[:-1]:
                        name, _, rest = line.partition(" ")
                        lines.setdefault(name, []).append(json.loads(rest))
                rows += [x for x in lines.get(key, ()) if not exact or x[0] == page_id]
            cols = list(zip(*rows, strict=True)) or [()] * 4
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64()]
            yield pa.record_batch([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=["page_id", "archive", "offset", "length"])

    return run


def lookup(index: Index, wanted: DataFrame) -> DataFrame:
    """(page_id, archive, offset, length) of captures of the distinct rows (key), or (key, page_id), of ``wanted``."""
    exact = "page_id" in wanted.columns
    shipped = wanted.sparkSession.sparkContext.broadcast(index.directory)
    schema = "block long, file string, at long, size long, key string, page_id long"
    placed = wanted.distinct().mapInArrow(_search(shipped, exact), schema)
    dealt = placed.repartition("block").sortWithinPartitions("block")
    return dealt.mapInArrow(_read_blocks(index.blocks, exact), CAPTURE)


RECORD = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary"


def _fetch(root: str, payloads: bool):
    names = [x.split(" ")[0] for x in RECORD.split(", ")][: None if payloads else -1]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranges = _Ranges(root)
        for batch in batches:
            found: list[list] = [[] for _ in names]
            for name, offset, length in zip(*(batch.column(c).to_pylist() for c in ("archive", "offset", "length")), strict=True):
                said = parse(ranges.read(name, offset, length))
                for column, field in zip(found, names, strict=True):
                    column.append(said[field])
            yield pa.record_batch([pa.array(c, t) for c, t in zip(found, kinds, strict=False)], names=names)

    return run


def read(index: Index, captures: DataFrame, *, payloads: bool = True) -> DataFrame:
    """Reads records by range, in the order of their archives; a damaged one fails the job."""
    near = F.floor(F.col("offset") / (8 * WINDOW))
    dealt = captures.repartition("archive", near).sortWithinPartitions("archive", "offset")
    schema = RECORD if payloads else RECORD.rpartition(", ")[0]
    return bounded(dealt).mapInArrow(_fetch(index.archives, payloads), schema)


def store(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least: int = LEAST) -> Index:
    """Archives pages in a folder of this session's and indexes their records."""
    spark = pages.sparkSession
    root = _full(spark, shared_path(spark, "warc"))
    where, path = _store(root)
    where.create_dir(path)
    captures = archive(pages, root, id_col=id_col, url_col=url_col, html_col=html_col, least=least)
    return build(captures, root)


def remove(spark: SparkSession, index: Index) -> None:
    """Deletes the archives and the index."""
    for path in (index.archives, index.blocks):
        drop(spark, path)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    index = store(pages)
    wanted = pages.select(surt(F.col("url")).alias("key"), F.col("page_id").cast("long").alias("page_id"))
    found = read(index, lookup(index, wanted), payloads=False)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, CAST(octet_length(b) AS BIGINT) AS n, sha256(b) AS digest FROM p),
f AS (SELECT digest, min(page_id) AS first FROM d WHERE n >= 100 GROUP BY digest)
SELECT page_id, n AS payload_bytes, d.digest AS payload_digest,
    CASE WHEN first IS NOT NULL AND first IS DISTINCT FROM page_id THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN first IS DISTINCT FROM page_id THEN first END AS refers_to
FROM d LEFT JOIN f ON d.digest = f.digest
"""
