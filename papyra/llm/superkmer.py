"""Substring dedup by super-k-mer partitioning.

A window is ``window`` consecutive words of one document. Its minimiser is the least hash among its
``mmer``-word runs. Consecutive windows with one minimiser travel as one packed string (the words of all of
them, joined by single spaces) to the bucket of that minimiser; equal windows have equal minimisers and so
meet in one bucket. There the windows are sorted by hash, and runs of one hash are compared word for word,
so counts are exact. A window is covered in every document but the one with the smallest doc_id.

Hot groups: a map task sends each distinct packed string once for each batch, for the batch's smallest
doc_id; windows of its other documents are covered already and travel as plain ranges. So the inside of a passage
that a third of all documents share reaches its bucket as one row for each batch. The strings at the
passage's ends differ in every document but have its minimisers; a first pass counts distinct strings for each
minimiser, and windows of those with over ``HEAVY_STRINGS`` have themselves as minimiser: each is a string of its own, in
the bucket of its own hash, compared word for word like all others. The heavy minimisers lie in files that tasks map.

A bucket holds a bounded number of bytes, worked through cell by cell: the number of buckets grows with the input.
Beyond ``FAN_OUT`` buckets strings are dealt twice, first to groups of buckets and then within each, so that
a blob always holds many strings. Strings of a blob are compressed together.

The ranges and the documents then meet in one sort on (doc_id, hash of text), read as a stream.

Nulls and empties: a null text has no words. A null doc_id counts as the largest number (2^63 - 1), and two null
ids as one document. Rows that repeat a doc_id don't cover one another. Rows that repeat both doc_id and
text are repeated in the result. Extra columns pass through.
An empty table gives an empty result.
"""

from __future__ import annotations

import functools
import struct
import uuid

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from papyra.llm.common import arrow_map, deal, filesystem, slices
from papyra.shared import input_bytes, shared_path, written

WINDOW, MMER = 50, 5
BUCKET_BYTES, SLICE_BYTES, FLUSH_BYTES = 40 << 20, 1 << 20, 20 << 20
SUB = 8  # cells of a bucket
HEAVY_STRINGS, FAN_OUT = 8192, 8192
_B, _C = np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_C), -1, 1 << 64))
_NULL_ID = (1 << 63) - 1
_META = [("sid", np.int32), ("doc", np.int64), ("text_hash", np.uint64), ("start", np.int32)]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def _run_hashes(h: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` consecutive values, from a running polynomial sum."""
    n = len(h)
    if n < width:
        return np.zeros(0, np.uint64)
    power = np.multiply.accumulate(np.full(n, _C, np.uint64))
    inverse = np.multiply.accumulate(np.full(n - width + 1, _INVERSE))
    total = np.concatenate([np.zeros(1, np.uint64), np.add.accumulate(_mix(h) * power)])
    return _mix((total[width:] - total[:-width]) * inverse)


def _least(h: np.ndarray, width: int) -> np.ndarray:
    """Least of each run of ``width`` consecutive values."""
    have = 1
    while have < width:
        step = min(have, width - have)
        h = np.minimum(h[:-step], h[step:])
        have += step
    return h


class _Words:
    """Words of a buffer in which single spaces part words and line ends part lists of words; no list is empty."""

    def __init__(self, buffer: bytes):
        self.buffer, letters = buffer, np.frombuffer(buffer, np.uint8)
        cuts = np.flatnonzero((letters == 32) | (letters == 10))
        self.of = np.concatenate([[0], np.cumsum(letters[cuts] == 10)])
        self.starts, self.ends = np.concatenate([[0], cuts + 1]), np.concatenate([cuts, [len(buffer)]])

    def hashes(self, chunk: int = 100_000) -> np.ndarray:
        """A 64-bit polynomial of each word's bytes."""
        letters, out = np.frombuffer(self.buffer, np.uint8), np.empty(len(self.starts), np.uint64)
        power = np.multiply.accumulate(np.full(int((self.ends - self.starts).max()) + 1, _B, np.uint64))
        for k in range(0, len(out), chunk):
            starts, ends = self.starts[k : k + chunk], self.ends[k : k + chunk]
            low, sizes = starts[0], ends - starts
            value = letters[low : ends[-1] + 1].astype(np.uint64) + np.uint64(1)
            place = np.arange(len(value)) - np.repeat(starts - low, sizes + 1)[: len(value)]
            value *= power[place]
            value[(ends - low)[ends - low < len(value)]] = 0
            out[k : k + chunk] = np.add.reduceat(value, starts - low)
        return out


class _SuperKmers:
    """Super-k-mers of some texts: ``text`` (index), ``start`` (first word in it), ``begin`` and ``end`` (words of the
    buffer), ``minimiser`` and, if asked for, ``content`` (a hash of the words)."""

    def __init__(self, texts: list[bytes], window: int, mmer: int, contents: bool = False):
        lists = [(i, b" ".join(w)) for i, w in enumerate(t.split() for t in texts) if len(w) >= window]
        self.text = self.start = self.begin = self.end = np.zeros(0, np.int64)
        self.minimiser = self.content = np.zeros(0, np.uint64)
        if not lists:
            return
        self.words = w = _Words(b"\n".join([x for _, x in lists]))
        hashes, of = w.hashes(), w.of
        least = _least(_run_hashes(hashes, mmer), window - mmer + 1)
        first = np.searchsorted(of, np.arange(len(lists)))
        valid = of[: len(least)] == of[window - 1 :]
        new = np.ones(len(least), bool)
        new[1:] = (least[1:] != least[:-1]) | ~valid[:-1] | (of[1 : len(least)] != of[: len(least) - 1])
        stop = np.ones(len(least), bool)
        stop[:-1] = new[1:] | ~valid[1:]
        self.begin, self.end = np.flatnonzero(valid & new), np.flatnonzero(valid & stop) + window
        self.text, self.start = np.array([i for i, _ in lists])[of[self.begin]], self.begin - first[of[self.begin]]
        self.minimiser = least[self.begin]
        if contents:
            total = np.concatenate([np.zeros(1, np.uint64), np.add.accumulate(_mix(hashes) * np.multiply.accumulate(np.full(len(hashes), _C)))])
            inverse = np.multiply.accumulate(np.full(len(hashes), _INVERSE))
            self.content = (total[self.end] - total[self.begin]) * inverse[self.begin]

    def packed(self, begin: int, end: int) -> bytes:
        return self.words.buffer[self.words.starts[begin] : self.words.ends[end - 1]]


class _Batch:
    """Super-k-mers of a batch: each distinct string once, for the smallest document."""

    def __init__(self):
        self.strings: dict[bytes, list] = {}
        self.bytes = 0
        self.covered: list[tuple[int, int, int, int]] = []

    def add(self, doc: int, text: int, start: int, minimiser: int, packed: bytes, n_words: int) -> None:
        kept = self.strings.get(packed)
        if kept is None:
            self.strings[packed] = [minimiser, n_words, doc, [(text, start)]]
            self.bytes += len(packed) + 200
        elif doc == kept[2]:
            kept[3].append((text, start))
            self.bytes += 100
        else:
            if doc > kept[2]:
                self.covered.append((doc, text, start, start + n_words))
            else:
                self.covered += [(kept[2], t, s, s + n_words) for t, s in kept[3]]
                kept[2:] = [doc, [(text, start)]]
            self.bytes += 100

    def rows(self, groups: int, cells: int):
        """(group, blob): a cell's part of a blob holds the places of its strings and then the strings."""
        by: dict[int, dict[int, list]] = {}
        for packed, (minimiser, _, doc, places) in self.strings.items():
            cell = (minimiser >> 20) % cells
            by.setdefault(cell % groups, {}).setdefault(cell, []).append((packed, doc, places))
        for group, of in by.items():
            parts = []
            for cell, own in of.items():
                meta = [(k, e[1], t, s) for k, e in enumerate(own) for t, s in e[2]]
                parts.append((cell, _packed_columns(meta, _META) + b"\n".join([e[0] for e in own])))
            yield group, _blob(parts)

    def ranges(self) -> list[tuple[int, int, int, int]]:
        """The covered ranges, with those that touch put together."""
        out: list[tuple[int, int, int, int]] = []
        for doc, text, start, end in sorted(self.covered):
            if out and out[-1][:2] == (doc, text) and start <= out[-1][3]:
                out[-1] = (doc, text, out[-1][2], max(end, out[-1][3]))
            else:
                out.append((doc, text, start, end))
        return out


_RANGES = [("doc", np.int64), ("text_hash", np.uint64), ("start", np.int32), ("end", np.int32)]


def _packed_columns(rows: list[tuple], fields) -> bytes:
    return struct.pack("<q", len(rows)) + b"".join(np.array([r[j] for r in rows], kind).tobytes() for j, (_, kind) in enumerate(fields))


def _unpack(blob: bytes, fields) -> tuple[dict[str, np.ndarray], bytes]:
    (n,), at, out = struct.unpack_from("<q", blob), 8, {}
    for name, kind in fields:
        out[name] = np.frombuffer(blob, kind, n, at)
        at += out[name].nbytes
    return out, blob[at:]


def _blob(parts: list[tuple[int, bytes]]) -> bytes:
    head = np.array([(cell, len(part)) for cell, part in parts], np.int64)
    return zstandard.ZstdCompressor(level=3).compress(struct.pack("<q", len(parts)) + head.tobytes() + b"".join(part for _, part in parts))


def _cells(blob: bytes) -> list[tuple[int, bytes]]:
    raw = zstandard.decompress(blob)
    (n,) = struct.unpack_from("<q", raw)
    at, out = 8 + 16 * n, []
    for cell, size in np.frombuffer(raw, np.int64, 2 * n, 8).reshape(n, 2).tolist():
        out.append((cell, raw[at : at + size]))
        at += size
    return out


def _bucket_ranges(blobs: list[bytes], window: int):
    """(doc, text_hash, start, end) arrays of what one bucket finds covered, cell by cell."""
    parts: dict[int, list[bytes]] = {}
    while blobs:
        for cell, part in _cells(blobs.pop()):
            parts.setdefault(cell, []).append(part)
    while parts:
        yield _part_ranges(parts.popitem()[1], window)


def _runs_of_unlike(w: _Words, members: np.ndarray, first: np.ndarray, sizes: np.ndarray, window: int) -> list[int]:
    """Runs of windows with one hash but different words. Each window is compared with the first of its run; windows that
    follow each other in the text, and whose firsts do too, are compared in one piece."""
    lead, run = np.repeat(members[first], sizes), np.repeat(np.arange(len(sizes)), sizes)
    order = np.argsort(members, kind="stable")
    k, lead, run = members[order], lead[order], run[order]
    start = np.flatnonzero(np.concatenate([[True], (k[1:] != k[:-1] + 1) | (lead[1:] != lead[:-1] + 1)]))
    stop = np.concatenate([start[1:], [len(k)]])
    a, b, x, y = w.starts[k[start]], w.ends[k[stop - 1] + window - 1], w.starts[lead[start]], w.ends[lead[stop - 1] + window - 1]
    unlike: set[int] = set()
    for s, e, a_, b_, x_, y_ in zip(start.tolist(), stop.tolist(), a.tolist(), b.tolist(), x.tolist(), y.tolist()):
        if a_ != x_ and w.buffer[a_:b_] != w.buffer[x_:y_]:
            for i in range(s, e):
                p, q = int(k[i]), int(lead[i])
                if w.buffer[w.starts[p] : w.ends[p + window - 1]] != w.buffer[w.starts[q] : w.ends[q + window - 1]]:
                    unlike.add(int(run[i]))
    return sorted(unlike)


def _only(members: np.ndarray, first: np.ndarray, sizes: np.ndarray, keep: np.ndarray):
    """The groups that ``keep`` marks; groups lie one after another in ``members``."""
    members, sizes = members[np.repeat(keep, sizes)], sizes[keep]
    return members, np.cumsum(sizes) - sizes, sizes


def _part_ranges(parts: list[bytes], window: int):
    metas, texts, n_strings = [], [], 0
    for part in parts:
        meta, text = _unpack(part, _META)
        metas.append((meta["sid"] + n_strings, meta["doc"], meta["text_hash"], meta["start"]))
        texts.append(text)
        n_strings += text.count(b"\n") + 1
    sid, doc, text, start = (np.concatenate([m[j] for m in metas]) for j in range(4))
    buffer = b"\n".join(texts)
    del texts, metas
    owner = np.zeros(n_strings, np.int64)
    owner[sid] = doc
    w = _Words(buffer)
    of = w.of
    hashes = _run_hashes(w.hashes(), window)
    inside = np.flatnonzero(of[: len(hashes)] == of[window - 1 :]) if len(hashes) else np.zeros(0, np.int64)
    inside = inside[np.argsort(hashes[inside], kind="stable")]
    hit = np.zeros(len(hashes), bool)
    new = np.concatenate([[True], hashes[inside[1:]] != hashes[inside[:-1]]]) if len(inside) else np.zeros(0, bool)
    first_of = np.flatnonzero(new)
    sizes = np.diff(np.concatenate([first_of, [len(inside)]]))
    inside, first_of, sizes = _only(inside, first_of, sizes, sizes > 1)
    if len(first_of):
        owners = owner[of[inside]]
        low, high = np.minimum.reduceat(owners, first_of), np.maximum.reduceat(owners, first_of)
        inside, first_of, sizes = _only(inside, first_of, sizes, low < high)
    if len(first_of):
        owners = owner[of[inside]]
        hit[inside[owners > np.repeat(np.minimum.reduceat(owners, first_of), sizes)]] = True
        for run in _runs_of_unlike(w, inside, first_of, sizes, window):
            members = inside[first_of[run] : first_of[run] + sizes[run]]
            groups: dict[bytes, list[int]] = {}
            for k in members.tolist():
                groups.setdefault(buffer[w.starts[k] : w.ends[k + window - 1]], []).append(k)
            for group in groups.values():
                of_each = owner[of[group]]
                hit[group] = of_each > of_each.min()
    spans = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
    begin, stop = spans[::2], spans[1::2]
    # A span of hits may run over the end of a string only through windows that are not inside, which are never hit.
    first = np.zeros(n_strings + 1, np.int64)
    np.cumsum(np.bincount(of, minlength=n_strings), out=first[1:])
    string = of[begin] if len(begin) else np.zeros(0, np.int64)
    by_sid = np.argsort(sid, kind="stable")
    low, high = np.searchsorted(sid[by_sid], string, "left"), np.searchsorted(sid[by_sid], string, "right")
    repeat = high - low
    place = by_sid[np.repeat(low, repeat) + np.arange(repeat.sum()) - np.repeat(np.cumsum(repeat) - repeat, repeat)]
    offset = np.repeat(begin - first[string], repeat)
    length = np.repeat(stop - begin + window - 1, repeat)
    return doc[place], text[place], (start[place] + offset).astype(np.int32), (start[place] + offset + length).astype(np.int32)


class _Heavy:
    """Minimisers of too many strings: sorted arrays in files of the shared folder."""

    def __init__(self, uri: str, files: list[str]):
        self.uri, self.files = uri, files

    def has(self, minimisers: np.ndarray) -> np.ndarray:
        found = np.zeros(len(minimisers), bool)
        for file in self.files:
            held = _held(self.uri, file)
            found |= held[np.minimum(np.searchsorted(held, minimisers), len(held) - 1)] == minimisers
        return found


@functools.lru_cache(maxsize=4096)
def _held(uri: str, file: str) -> np.ndarray:
    fs, path = filesystem(uri)
    with fs.open_input_file(f"{path}/{file}") as f:
        return np.frombuffer(f.read_buffer(), np.uint64)


def heavy_minimisers(docs: DataFrame, window: int = WINDOW, mmer: int = MMER, heavy_strings: int = HEAVY_STRINGS) -> _Heavy:
    """Minimisers with more than ``heavy_strings`` distinct strings, counted batch by batch; the driver holds names of files."""
    uri = shared_path(docs.sparkSession, "heavy")

    def count(batches):
        for batch in batches:
            pairs = [np.zeros((0, 2), np.uint64)]
            for part in slices([batch], "text", SLICE_BYTES):
                found = _SuperKmers(part.column("text").to_pylist(), window, mmer, contents=True)
                pairs.append(np.stack([found.minimiser, found.content], axis=1))
            all_pairs = np.concatenate(pairs)
            all_pairs = all_pairs[np.lexsort((all_pairs[:, 1], all_pairs[:, 0]))]
            new = np.ones(len(all_pairs), bool)
            new[1:] = (all_pairs[1:] != all_pairs[:-1]).any(axis=1)
            minimiser, n = np.unique(all_pairs[new, 0], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(minimiser.view(np.int64)), pa.array(n)], ["minimiser", "n"])

    def save(batches):
        held = [batch.column(0).to_numpy().view(np.uint64) for batch in batches]
        if sum(map(len, held)):
            fs, path = filesystem(uri)
            fs.create_dir(path, recursive=True)
            file = f"heavy-{uuid.uuid4().hex}"
            with fs.open_output_stream(f"{path}/{file}", compression=None) as f:
                f.write(np.sort(np.concatenate(held)).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array([file])], ["file"])

    texts = docs.where("text is not null").select(F.col("text").cast("binary").alias("text"))
    counts = arrow_map(texts, count, "minimiser long, n long").groupBy("minimiser").agg(F.sum("n").alias("n"))
    files = written(arrow_map(counts.where(F.col("n") > heavy_strings).select("minimiser"), save, "file string"), "heavy-files")
    return _Heavy(uri, sorted(r["file"] for r in files.collect()))


def covered_ranges(docs: DataFrame, window: int = WINDOW, mmer: int = MMER, bucket_bytes: int = BUCKET_BYTES, heavy_strings: int = HEAVY_STRINGS, fan_out: int = FAN_OUT) -> DataFrame:
    """(doc, text_hash, start, end): ranges of words covered by windows that a smaller doc_id also has."""
    mmer = min(mmer, window)
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Packed strings come to about three times the text, the text to about twice its compressed columns.
    buckets = max(parts, -(-input_bytes(docs) * 6 // bucket_bytes))
    rounds = -(-buckets // fan_out)
    groups = -(-buckets // rounds)  # a group is ``rounds`` buckets
    buckets = groups * rounds
    heavy = heavy_minimisers(docs, window, mmer, heavy_strings)

    def pack(batches):
        batch, base = _Batch(), None
        for part in slices(batches, "text", SLICE_BYTES):
            base = part.column("here")[0].as_py() if base is None else base
            ids, hashes = part.column("doc").to_pylist(), part.column("text_hash").to_numpy().view(np.uint64).tolist()
            found = _SuperKmers(part.column("text").to_pylist(), window, mmer)
            hot = heavy.has(found.minimiser)
            for i, start, begin, end, minimiser, single in zip(*(c.tolist() for c in (found.text, found.start, found.begin, found.end, found.minimiser, hot))):
                if not single:
                    batch.add(ids[i], hashes[i], start, minimiser, found.packed(begin, end), end - begin)
                    continue
                for k in range(begin, end - window + 1):
                    packed = found.packed(k, k + window)
                    batch.add(ids[i], hashes[i], start + k - begin, xxhash.xxh3_64_intdigest(packed), packed, window)
                    if batch.bytes >= FLUSH_BYTES:
                        yield from flush(batch, base)
                        batch = _Batch()
            if batch.bytes >= FLUSH_BYTES:
                yield from flush(batch, base)
                batch = _Batch()
        if base is not None:
            yield from flush(batch, base)

    def flush(batch, base):
        rows = list(batch.rows(groups, buckets * SUB))
        if batch.covered:
            rows.append((-1 - base % parts, _packed_columns(batch.ranges(), _RANGES)))
        yield from dealt_out(rows)

    def dealt_out(rows):
        for k in range(0, len(rows), 64):
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows[k : k + 64]], pa.int64()), pa.array([r[1] for r in rows[k : k + 64]], pa.binary())], ["bucket", "blob"])

    def regroup(batches):
        """The second deal: parts of a group's blobs, put together for each bucket."""
        held, size = {}, 0
        for batch in batches:
            for group, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if group < 0:
                    yield from dealt_out([(group, blob)])
                    continue
                for cell, part in _cells(blob):
                    held.setdefault(cell % buckets, []).append((cell, part))
                    size += len(part)
                if size >= FLUSH_BYTES:
                    yield from dealt_out([(bucket, _blob(p)) for bucket, p in held.items()])
                    held, size = {}, 0
        yield from dealt_out([(bucket, _blob(p)) for bucket, p in held.items()])

    def merge(batches):
        at, blobs = None, []
        for batch in batches:
            for bucket, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if bucket < 0:
                    ranges, _ = _unpack(blob, _RANGES)
                    yield out(*(ranges[name] for name, _ in _RANGES))
                    continue
                if bucket != at and blobs:
                    for found in _bucket_ranges(blobs, window):
                        yield out(*found)
                    blobs = []
                at = bucket
                blobs.append(blob)
        if blobs:
            for found in _bucket_ranges(blobs, window):
                yield out(*found)

    def out(doc, text, start, end):
        return pa.RecordBatch.from_arrays([pa.array(doc), pa.array(text.view(np.int64)), pa.array(start), pa.array(end)], ["doc", "text_hash", "start", "end"])

    texts = docs.where("text is not null").select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_NULL_ID)).alias("doc"), F.xxhash64("text").alias("text_hash"), F.col("text").cast("binary").alias("text"), F.spark_partition_id().alias("here"))
    dealt = deal(arrow_map(texts, pack, "bucket long, blob binary"), parts, "bucket")
    if rounds > 1:
        dealt = deal(arrow_map(dealt.sortWithinPartitions("bucket"), regroup, "bucket long, blob binary"), parts, "bucket")
    return arrow_map(dealt.sortWithinPartitions("bucket"), merge, "doc long, text_hash long, start int, end int")


def drop_repeated(docs: DataFrame, window: int = WINDOW, mmer: int = MMER, bucket_bytes: int = BUCKET_BYTES, heavy_strings: int = HEAVY_STRINGS, fan_out: int = FAN_OUT, verbatim: bool = False) -> DataFrame:
    """(row, kept_text, n_words, n_removed): row holds the columns of ``docs`` but ``text``, whatever their names.

    kept_text is the kept words joined by single spaces; with ``verbatim``, texts that lose no word stay as they
    are, nulls too.
    """
    columns = [c for c in docs.columns if c != "text"]
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = covered_ranges(docs, window, mmer, bucket_bytes, heavy_strings, fan_out)
    row = F.struct(F.lit(True).alias("given"), *[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(columns)]).alias("row")
    base = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_NULL_ID)).alias("doc"), F.xxhash64("text").alias("text_hash"), F.lit(1).alias("kind"), F.lit(0).alias("start"), F.lit(0).alias("end"), F.col("text").cast("binary").alias("bytes"), row)
    kind = base.schema["row"].dataType
    ranges = ranges.select("doc", "text_hash", F.lit(0).alias("kind"), "start", "end", F.lit(None).cast("binary").alias("bytes"), F.lit(None).cast(kind).alias("row"))
    # By id and text: documents without an id are many, and only rows of one text need each other.
    dealt = ranges.unionByName(base).repartition(parts, "doc", "text_hash").sortWithinPartitions("doc", "text_hash", "kind")

    def cut(batches):
        at, spans = None, []
        for batch in slices(batches, "bytes", 4 << 20):
            doc, text, role, start, end = (batch.column(k).to_pylist() for k in range(5))
            bytes_, rows, kept, n_words, n_removed = batch.column(5), [], [], [], []
            for i in range(batch.num_rows):
                if (doc[i], text[i]) != at:
                    at, spans = (doc[i], text[i]), []
                if role[i] == 0:
                    spans.append((start[i], end[i]))
                    continue
                whole = bytes_[i].as_py()
                words = keep = (whole or b"").split()
                if spans:
                    depth = np.zeros(len(words) + 1, np.int32)
                    np.add.at(depth, [s for s, _ in spans], 1)
                    np.add.at(depth, [e for _, e in spans], -1)
                    keep = [w for w, d in zip(words, np.cumsum(depth)[:-1].tolist()) if not d]
                rows.append(i)
                kept.append(whole if verbatim and len(keep) == len(words) else b" ".join(keep))
                n_words.append(len(words))
                n_removed.append(len(words) - len(keep))
            if rows:
                text_out = pa.array(kept, pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([batch.column(6).take(pa.array(rows)), text_out, pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64())], ["row", "kept_text", "n_words", "n_removed"])

    schema = T.StructType([T.StructField("row", kind), T.StructField("kept_text", T.StringType()), T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType())])
    done = arrow_map(dealt, cut, schema)
    named = F.struct(*[F.col("row").getField(f"c{k}").alias(c) for k, c in enumerate(columns)])
    return done.select(named.alias("row"), "kept_text", "n_words", "n_removed")


def cut_texts(docs: DataFrame, **how) -> DataFrame:
    """``docs`` with the covered words cut out of ``text``; a column ``n_chars`` counts the characters of texts that lost some. All
    other columns pass unchanged, whatever their names."""
    done = drop_repeated(docs, verbatim=True, **how)

    def column(c: str):
        kind, old = docs.schema[c].dataType, F.col("row").getField(c)
        if c == "text":
            return F.col("kept_text").cast(kind).alias(c)
        if c == "n_chars":
            old = F.when(F.col("n_removed") > 0, F.length("kept_text")).otherwise(old).cast(kind)
        return old.alias(c)

    return done.select(*[column(c) for c in docs.columns])
