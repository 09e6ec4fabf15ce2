"""Deterministic sharded WARC writer, and its reader.

Records are put in one order: (page_id, payload digest, url), nulls first. Running sums of their sizes in it, which don't
depend on how Spark deals the rows, cut them into shards of equal bytes; the keys at which shards begin lie in a table of the
shared folder that tasks read. Pages and the decisions about equal payloads travel through one shuffle to their
shard and are sorted there, so a page's payload is shuffled once. A task writes a shard record by record, each a gzip
member, and begins a new file when the compressed size passes ``roll_bytes``. All headers (record ids, dates,
lengths, digests) come from the data, so the same pages give the same bytes.

Files are written under temporary names with a random part. The rows that successful tasks return are the
manifest; it is written first, then the files it names get their final names, then the manifest gets its
own, and the temporary folder goes. A lost executor leaves temporary files that no manifest names; a run that was
stopped is simply run again at the same place, which first removes what an earlier run left there (the manifest before all else).

A URL with blanks or control characters is escaped in WARC-Target-URI and stands unchanged in the header X-Page-URL, quoted.
Nulls and empties: a null html is an empty payload; a null url leaves out WARC-Target-URI; a null page_id is
written as "null" and read back as null; in a group of equal payloads with no page_id at all the first is the
response. Of rows that repeat page_id and payload the first by url is the response, the others revisit it; they share a shard. Extra columns
are ignored; an empty table gives no files and an empty result.
"""

from __future__ import annotations

import base64
import bisect
import functools
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from papyra.llm.common import arrow_map, deal, filesystem, slices
from papyra.operators.ranks import global_row_number, prefix_sums
from papyra.shared import shared_path, written

ROLL_BYTES, SHARD_PAYLOAD, MIN_REVISIT, LEVEL = 64 << 20, 64 << 20, 0, 5
HEADERS = 600  # bytes that a record's headers are taken to have
MAX_TASKS = 20_000  # beyond so many shards, a task writes several, one after another
DATE = "1970-01-01T00:00:00Z"
_FINAL = re.compile(r"part-\d{6,}-\d{4,}\.warc\.gz")
_FILE = "file string, tmp string, records long, bytes long, sha256 string, shard long"


def digest(payload: bytes) -> str:
    """Base32 of the SHA-1, upper case."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _name(page_id: int | None, payload_digest: str, copy: int) -> str:
    return f"<urn:x-page:{'null' if page_id is None else page_id}:{payload_digest}:{copy}>"


def _safe(url: str) -> str:
    return "".join(c if " " < c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in url)


def record(kind: str, record_id: str, headers: list[tuple[str, str]], content_type: str, block: bytes, date: str = DATE) -> bytes:
    """One record as a gzip member."""
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id}", f"WARC-Date: {date}"]
    lines += [f"{k}: {v}" for k, v in headers] + [f"Content-Type: {content_type}", f"Content-Length: {len(block)}"]
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + packer.flush()


def page_record(page_id: int | None, url: str | None, payload: bytes, payload_digest: str, copy: int, refers_to: str | None) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    headers = [("WARC-Target-URI", _safe(url))] if url is not None else []
    if url is not None and _safe(url) != url:
        headers.append(("X-Page-URL", quote(url)))
    headers.append(("WARC-Payload-Digest", f"sha1:{payload_digest}"))
    block = http + (payload if refers_to is None else b"")
    headers.append(("WARC-Block-Digest", f"sha1:{digest(block)}"))
    if refers_to is not None:
        headers += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Refers-To", refers_to)]
    kind = "response" if refers_to is None else "revisit"
    return record(kind, _name(page_id, payload_digest, copy), headers, "application/http; msgtype=response", block)


class _Files:
    """The files of one shard, in turn."""

    def __init__(self, uri: str, run: str, shard: int, roll_bytes: int):
        (self.fs, self.path), self.run = filesystem(uri), run
        self.shard, self.roll, self.seq, self.out, self.rows = shard, roll_bytes, 0, None, []

    def add(self, member: bytes) -> None:
        if self.out is None:
            self.file = f"part-{self.shard:06d}-{self.seq:04d}.warc.gz"
            self.tmp = f"_temporary/{self.run}/{self.file}.{uuid.uuid4().hex}"
            self.fs.create_dir(f"{self.path}/_temporary/{self.run}", recursive=True)
            self.out, self.hash, self.n, self.bytes = self.fs.open_output_stream(f"{self.path}/{self.tmp}", compression=None), hashlib.sha256(), 0, 0
            info = f"software: papyra\r\nformat: WARC File Format 1.1\r\nisPartOf: {self.file}\r\n".encode()
            self._put(record("warcinfo", f"<urn:x-file:{self.file}>", [("WARC-Filename", self.file)], "application/warc-fields", info))
        self._put(member)
        self.n += 1
        if self.bytes >= self.roll:
            self.close()

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.hash.update(data)
        self.bytes += len(data)

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.rows.append((self.file, self.tmp, self.n, self.bytes, self.hash.hexdigest(), self.shard))
            self.out, self.seq = None, self.seq + 1


def write_archives(pages: DataFrame, uri: str, roll_bytes: int = ROLL_BYTES, shard_payload: int = SHARD_PAYLOAD, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """Write the archives under ``uri`` and return the committed manifest, one row per file."""
    base = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("binary"), F.lit(b"")).alias("html"))
    narrow = base.select("page_id", "url", F.sha1("html").alias("sha1"), F.length("html").cast("long").alias("bytes"))
    ranked = global_row_number(narrow, [F.asc_nulls_first("page_id"), F.asc("sha1"), F.asc_nulls_first("url")], "rank")
    ranked = written(ranked, "warc-ranks")
    run = uuid.uuid4().hex
    _clear(uri)
    upto = prefix_sums(ranked.withColumn("cost", F.col("bytes") + HEADERS), "rank", "cost", "before")
    shard = F.floor(F.col("before") / F.lit(shard_payload))
    # One key for each shard: as many as shards, not as rows.
    heads = written(upto.groupBy(shard.alias("shard")).agg(F.min_by(F.struct("page_id", "sha1"), "rank").alias("key")).select("shard", "key.*"), "warc-shards")
    n_shards, at = heads.count(), heads.inputFiles()
    groups = ranked.where(F.col("bytes") >= min_revisit).groupBy("sha1").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1")
    groups = written(groups.select("sha1", "first"), "warc-groups")
    copies = ranked.select("page_id", "sha1").distinct().join(groups, "sha1")
    nothing = F.lit(None)
    told = copies.select("page_id", nothing.cast("string").alias("url"), nothing.cast("binary").alias("html"), "sha1", "first", F.lit(0).alias("kind"))
    rows = told.unionByName(base.withColumns({"sha1": nothing.cast("string"), "first": nothing.cast("long"), "kind": F.lit(1)}))

    def place(batches):
        starts = _starts(tuple(at))
        for batch in batches:
            ids, htmls, known = (batch.column(k).to_pylist() for k in (0, 2, 3))
            sha1 = [k if k is not None else hashlib.sha1(h).hexdigest() for k, h in zip(known, htmls)]
            shard = starts.of(ids, sha1)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(sha1, pa.string()), batch.column(4), batch.column(5), pa.array(shard, pa.int64())], ["page_id", "url", "html", "sha1", "first", "kind", "shard"])

    spark = pages.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = arrow_map(rows, place, "page_id long, url string, html binary, sha1 string, first long, kind int, shard long")
    dealt = deal(placed, max(parts, min(n_shards, MAX_TASKS)), "shard").sortWithinPartitions("shard", F.asc_nulls_first("page_id"), "sha1", "kind", F.asc_nulls_first("url"))

    def write(batches):
        files, at, first, copy = None, None, None, 0
        for batch in slices(batches, "html", 4 << 20):
            for page_id, url, html, sha1, low, kind, shard in zip(*(batch.column(k).to_pylist() for k in range(7))):
                if files is None or files.shard != shard:
                    if files is not None:
                        files.close()
                        yield from listed(files)
                    files = _Files(uri, run, shard, roll_bytes)
                if (page_id, sha1) != at:
                    at, first, copy = (page_id, sha1), (False, None), 0
                if kind == 0:
                    first = (True, low)
                    continue
                payload_digest = base64.b32encode(bytes.fromhex(sha1)).decode()
                grouped, low = first
                revisit = grouped and (page_id != low or copy > 0)
                files.add(page_record(page_id, url, html, payload_digest, copy, _name(low, payload_digest, 0) if revisit else None))
                copy += 1
        if files is not None:
            files.close()
            yield from listed(files)

    def listed(files):
        if files.rows:
            columns = list(zip(*files.rows))
            kinds = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["file", "tmp", "records", "bytes", "sha256", "shard"])

    pending = f"{uri}/_temporary/{run}/manifest"
    arrow_map(dealt, write, _FILE).write.parquet(pending)
    manifest = spark.read.schema(_FILE).parquet(pending)

    def commit(batches):
        for batch in batches:
            fs, path = filesystem(uri)
            for tmp, file in zip(batch.column("tmp").to_pylist(), batch.column("file").to_pylist()):
                _rename(fs, f"{path}/{tmp}", f"{path}/{file}")
            yield batch

    final = f"{uri}/manifest"
    arrow_map(manifest, commit, _FILE).select("file", "records", "bytes", "sha256", "shard").write.mode("overwrite").parquet(final)
    fs, path = filesystem(uri)
    fs.delete_dir(f"{path}/_temporary")
    return spark.read.schema("file string, records long, bytes long, sha256 string, shard long").parquet(final)


def _clear(uri: str) -> None:
    """Remove what an earlier run left under ``uri``; other files there stay."""
    from pyarrow.fs import FileSelector, FileType

    fs, path = filesystem(uri)
    if fs.get_file_info(path).type == FileType.NotFound:
        return
    for folder in ("manifest", "_temporary"):
        fs.delete_dir_contents(f"{path}/{folder}", missing_dir_ok=True)
    for info in fs.get_file_info(FileSelector(path)):
        if _FINAL.fullmatch(info.base_name):
            fs.delete_file(info.path)


def _rename(fs, old: str, new: str) -> None:
    """Safe to repeat: a retried task finds the new name in place."""
    from pyarrow.fs import FileType

    if fs.get_file_info(old).type == FileType.NotFound:
        if fs.get_file_info(new).type == FileType.NotFound:
            raise FileNotFoundError(old)
        return
    if fs.get_file_info(new).type != FileType.NotFound:
        fs.delete_file(new)
    fs.move(old, new)


class _Starts:
    """The keys at which shards begin, in order: null ids first, then by id and digest."""

    def __init__(self, ids: list, digests: list):
        order = sorted(range(len(ids)), key=lambda k: (ids[k] is not None, ids[k] or 0, digests[k]))
        self.nulls = [digests[k] for k in order if ids[k] is None]
        self.ids = np.array([ids[k] for k in order if ids[k] is not None], np.int64)
        self.digests = np.array([digests[k] for k in order if ids[k] is not None], "S40")

    def of(self, ids: list, digests: list[str]) -> list[int]:
        values = np.array([i or 0 for i in ids], np.int64)
        low, high = (len(self.nulls) + np.searchsorted(self.ids, values, side) for side in ("left", "right"))
        out = (high - 1).tolist()
        for k, (i, d) in enumerate(zip(ids, digests)):
            if i is None:
                out[k] = bisect.bisect_right(self.nulls, d) - 1
            elif high[k] > low[k]:
                at = slice(low[k] - len(self.nulls), high[k] - len(self.nulls))
                out[k] = int(low[k] + np.searchsorted(self.digests[at], d.encode(), "right")) - 1
        return [max(0, x) for x in out]


@functools.lru_cache(maxsize=2)
def _starts(files: tuple[str, ...]) -> _Starts:
    import pyarrow.parquet as pq

    tables = []
    for file in files:
        fs, path = filesystem(file)
        with fs.open_input_file(path) as f:
            tables.append(pq.read_table(f, columns=["page_id", "sha1"]))
    table = pa.concat_tables(tables) if tables else pa.table({"page_id": pa.array([], pa.int64()), "sha1": pa.array([], pa.string())})
    return _Starts(table.column(0).to_pylist(), table.column(1).to_pylist())


def _members(stream) -> Iterator[bytes]:
    """The gzip members of a stream, decompressed one by one."""
    data = b""
    while data := data or stream.read(1 << 20):
        unpacker, out = zlib.decompressobj(31), []
        while not unpacker.eof:
            if not data and not (data := stream.read(1 << 20)):
                raise EOFError("the archive ends within a record")
            out.append(unpacker.decompress(data))
            data = unpacker.unused_data if unpacker.eof else b""
        yield b"".join(out)


def parse(member: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (lower-case names) and block of a record; a length or block digest that doesn't fit is an error."""
    head, _, rest = member.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    headers = {k.lower(): v for k, v in (x.split(": ", 1) for x in lines[1:])}
    block = rest[: int(headers["content-length"])]
    if not lines[0].startswith("WARC/") or rest[len(block) :] != b"\r\n\r\n":
        raise ValueError(f"malformed record {headers.get('warc-record-id')}")
    if "warc-block-digest" in headers and headers["warc-block-digest"] != f"sha1:{digest(block)}":
        raise ValueError(f"block digest of {headers['warc-record-id']}")
    return headers, block


def _page(name: str) -> int | None:
    page = name.split(":")[2]
    return None if page == "null" else int(page)


def read_archives(spark: SparkSession, uri: str, payloads: bool = False) -> DataFrame:
    """One row per page record of the archives that the manifest under ``uri`` names, each checked against its digests."""
    manifest = spark.read.parquet(f"{uri}/manifest").select("file")
    fields = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long" + ", payload binary" * payloads
    names = [f.split()[0] for f in fields.split(", ")]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]

    def batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    def run(batches):
        fs, path = filesystem(uri)
        for given in batches:
            for file in given.column(0).to_pylist():
                rows, held = [], 0
                with fs.open_input_stream(f"{path}/{file}", compression=None) as stream:
                    for member in _members(stream):
                        headers, block = parse(member)
                        if headers["warc-type"] == "warcinfo":
                            continue
                        http, _, payload = block.partition(b"\r\n\r\n")
                        length = next(int(x[16:]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length: "))
                        own, refers = headers["warc-payload-digest"].removeprefix("sha1:"), headers.get("warc-refers-to")
                        if refers is None and (len(payload) != length or digest(payload) != own):
                            raise ValueError(f"payload of {headers['warc-record-id']}")
                        url = unquote(headers["x-page-url"]) if "x-page-url" in headers else headers.get("warc-target-uri")
                        row = (_page(headers["warc-record-id"]), url, length, own, headers["warc-type"], _page(refers) if refers else None)
                        rows.append(row + ((payload if refers is None else None,) if payloads else ()))
                        held += 200 + len(payload) * payloads
                        if held > 4 << 20:
                            yield batch(rows)
                            rows, held = [], 0
                if rows:
                    yield batch(rows)

    files = manifest.count()
    return arrow_map(manifest.repartition(max(1, files), "file"), run, fields)


def round_trip(pages: DataFrame, **how) -> DataFrame:
    """Write ``pages`` as archives in the shared folder and read them back."""
    spark = pages.sparkSession
    uri = shared_path(spark, "warc")
    write_archives(pages, uri, **how)
    return read_archives(spark, uri)
