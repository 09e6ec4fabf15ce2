"""Interpolated modified Kneser-Ney language model (bigrams), counted in Spark, looked up in mapped files.

Counting: each slice of text gives its distinct bigrams with counts, as packed arrays for the buckets of a
shuffle. A bucket adds them up, writes the bigrams seen ``min_count`` times or more as a sorted hash array in
the shared folder, and sends on, for each word, its count, its number of distinct predecessors, and as a
context its total and numbers of followers seen once, twice and more often. A second shuffle adds those up
for each word and writes sorted hash arrays too. Discounts come from the counts of counts. Counts are of
64 bits, stored in as few bytes as the largest of a file needs.

A bigram's bucket is that of its context, so a context's figures mostly arrive in one piece; contexts with
more than a fraction of a bucket's share of all tokens (found by a pass over all tokens, at most 8 for
each bucket) are dealt by the whole bigram. There are at most ``FAN_OUT`` buckets, which bounds what the driver holds,
the files and the blobs a slice makes. Beyond that, a bucket's bigrams are dealt once more, by ranges of their hashes, and added up
and appended to its file range by range, so memory stays bounded; a file ends with the places of its pieces.

With ``min_count`` 1, as the query has it, every bigram is stored and has its own discount. Above that, bigrams under ``min_count``
are counted in every figure but not stored: their mass goes to the back-off weight of their context, so each
distribution still sums to one.

Scoring: workers map the files and search them for the distinct words and bigrams of a slice, in order.
The order is two: see the README for the figures.

Nulls and empties: a null text is empty and scores as one end token. A null doc_id is trained on. Repeated
rows count as often as they stand there. Extra columns are ignored. With no training rows every
word is unknown and the model is uniform over that one type, so score is 0 for every text.
"""

from __future__ import annotations

import functools
import json
import mmap
import struct
import uuid

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from papyra.llm.common import arrow_map, deal, filesystem, slices
from papyra.shared import input_bytes, shared_path, written

MIN_COUNT, SLICE_BYTES, BUCKET_GRAMS, FAN_OUT, HEAVY_SHARE = 1, 6 << 20, 2_000_000, 4096, 8
_END, _START = (np.uint64(xxhash.xxh3_64_intdigest(x)) for x in (b"\n", b"\r"))
_C = np.uint64(0x9E3779B97F4A7C15)
_GRAM, _WORD = 2, 7  # columns: key and count; key, count, before, total, once, twice, more


def tokens(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the tokens of all texts in a row, each text closed by an end token; and the texts' lengths."""
    words = [(t or b"").lower().split() for t in texts]
    lengths = np.array([len(w) + 1 for w in words], np.int64)
    digest = xxhash.xxh3_64_digest
    flat = np.frombuffer(b"".join([digest(w) for ws in words for w in ws]), ">u8").astype(np.uint64)
    out = np.full(lengths.sum(), _END, np.uint64)
    inner = np.ones(len(out), bool)
    inner[np.cumsum(lengths) - 1] = False
    out[inner] = flat
    return out, lengths


def _contexts(toks: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    before = np.empty_like(toks)
    before[1:] = toks[:-1]
    before[np.cumsum(lengths) - lengths] = _START
    return before


def gram_keys(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    x = context * _C + word
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _grams_bucket(context, key, heavy: np.ndarray, buckets: int) -> np.ndarray:
    by = np.where(np.isin(context, heavy), key, context) if len(heavy) else context
    return (by % np.uint64(buckets)).astype(np.int64)


def _narrow(column: np.ndarray) -> np.ndarray:
    """The same whole numbers in as few bytes as the largest needs."""
    return column.astype(np.min_scalar_type(int(column.max())) if len(column) else np.uint8)


def _pack(columns: list[np.ndarray]) -> bytes:
    narrow = [_narrow(c) for c in columns]
    head = struct.pack(f"<q{len(narrow)}B", len(columns[0]), *(c.itemsize for c in narrow))
    return zstandard.ZstdCompressor(level=1).compress(head + b"".join(c.tobytes() for c in narrow))


def _arrays(raw, n: int, sizes, at: int) -> list[np.ndarray]:
    out = []
    for size in sizes:
        out.append(np.frombuffer(raw, f"u{size}", n, at))
        at += n * size
    return out


def _unpack(blob: bytes, columns: int) -> list[np.ndarray]:
    raw = zstandard.decompress(blob)
    n, *sizes = struct.unpack_from(f"<q{columns}B", raw)
    return _arrays(raw, n, sizes, 8 + columns)


def _blobs(bucket: np.ndarray, columns: list[np.ndarray], kind: int):
    """(bucket, kind, blob) rows; columns are in the order that blobs should keep within a bucket."""
    order = np.argsort(bucket, kind="stable")
    bucket, columns = bucket[order], [c[order] for c in columns]
    cuts = np.flatnonzero(np.diff(bucket)) + 1
    for s, e in zip([0, *cuts.tolist()], [*cuts.tolist(), len(bucket)]):
        if e > s:
            yield int(bucket[s]), kind, _pack([c[s:e] for c in columns])


def _batch(rows: list, names=("bucket", "kind", "blob")) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.binary())], list(names))


def _sums(key: np.ndarray, columns: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Distinct keys in order, and each column summed over them."""
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    return key[first], [np.add.reduceat(c[order].astype(np.int64), first) if len(first) else np.zeros(0, np.int64) for c in columns]


class _File:
    """A bucket's file: pieces of sorted arrays, one after another, and at the end their places, lengths and widths."""

    def __init__(self, uri: str, name: str):
        fs, path = filesystem(uri)
        fs.create_dir(path, recursive=True)
        self.name, self.at, self.pieces = f"{name}-{uuid.uuid4().hex}.bin", 0, []
        self.out = fs.open_output_stream(f"{path}/{self.name}", compression=None)

    def add(self, piece: int, columns: list[np.ndarray]) -> None:
        narrow = [columns[0], *(_narrow(c) for c in columns[1:])]
        self.pieces.append((piece, self.at, len(columns[0]), *(c.itemsize for c in narrow)))
        for c in narrow:
            self.out.write(np.ascontiguousarray(c).tobytes())
            self.at += c.nbytes

    def close(self) -> str:
        table = np.array(self.pieces, np.int64)
        self.out.write(table.tobytes() + struct.pack("<qq", *table.shape))
        self.out.close()
        return self.name


@functools.lru_cache(maxsize=FAN_OUT)
def _mapped(uri: str, file: str) -> dict[int, list[np.ndarray]]:
    """The pieces of a file: mapped where the shared folder is mounted, read whole from other stores."""
    fs, path = filesystem(uri)
    if fs.type_name == "local":
        with open(f"{path}/{file}", "rb") as f:
            raw = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ, trackfd=False)
    else:
        with fs.open_input_file(f"{path}/{file}") as f:
            raw = f.read_buffer()
    rows, columns = struct.unpack_from("<qq", raw, len(raw) - 16)
    table = np.frombuffer(raw, np.int64, rows * columns, len(raw) - 16 - 8 * rows * columns).reshape(rows, columns)
    return {piece: _arrays(raw, n, sizes, at) for piece, at, n, *sizes in table.tolist()}


def _piece(key: np.ndarray, pieces: int) -> np.ndarray:
    """The range of hashes, of so many, that a key is in; in the order of the keys."""
    return ((key >> np.uint64(40)) * np.uint64(pieces) >> np.uint64(24)).astype(np.int64)


def _lookup(uri: str, files: dict[int, str], columns: int, pieces: int, bucket: np.ndarray, key: np.ndarray) -> list[np.ndarray]:
    """For distinct keys: the stored figures, 0 where there are none."""
    found = [np.zeros(len(key), np.int64) for _ in range(columns - 1)]
    order = np.lexsort((key, bucket))
    place = bucket[order] * pieces + _piece(key[order], pieces)
    cuts = np.flatnonzero(np.diff(place)) + 1
    for s, e in zip([0, *cuts.tolist()], [*cuts.tolist(), len(order)]):
        if s == e or int(place[s]) // pieces not in files:
            continue
        held = _mapped(uri, files[int(place[s]) // pieces]).get(int(place[s]) % pieces)
        if held is None or not len(held[0]):
            continue
        rows = order[s:e]
        at = np.searchsorted(held[0], key[rows])
        at[at == len(held[0])] = 0
        hit = held[0][at] == key[rows]
        for out, column in zip(found, held[1:]):
            out[rows[hit]] = column[at[hit]]
    return found


def _discounts(n: list[int]) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts from the counts of counts 1 to 4; half steps where these are degenerate."""
    if min(n[:3]) <= 0:
        return 0.5, 1.0, 1.5
    y = n[0] / (n[0] + 2 * n[1])
    d = [1 - 2 * y * n[1] / n[0], 2 - 3 * y * n[2] / n[1], 3 - 4 * y * n[3] / n[2]]
    return tuple(min(max(x, 0.05), k + 0.95) for k, x in enumerate(d))


class Model:
    """Places and figures of a fitted model; small, and sent with the tasks."""

    def __init__(self, uri: str, buckets: int, pieces: int, heavy: np.ndarray, rows: list, min_count: int):
        self.uri, self.buckets, self.pieces, self.heavy, self.min_count = uri, buckets, pieces, heavy, min_count
        self.grams, self.words = ({r["bucket"]: r["file"] for r in rows if r["kind"] == kind} for kind in (0, 1))
        of = lambda kind, k: sum(r[k] for r in rows if r["kind"] == kind)
        self.d_gram, self.d_word = (_discounts([of(kind, f"n{k}") for k in (1, 2, 3, 4)]) for kind in (0, 1))
        self.train_tokens, self.vocabulary, self.types = of(1, "tokens"), of(1, "types"), of(1, "before")
        left = sum(d * n for d, n in zip(self.d_word, (of(1, "n1"), of(1, "n2"), of(1, "types") - of(1, "n1") - of(1, "n2"))))
        self.rest = left / self.types if self.types else 1.0

    def word_figures(self, key: np.ndarray):
        """Count, unigram probability and, as contexts, total and back-off weight of distinct words."""
        count, before, total, once, twice, more = _lookup(self.uri, self.words, _WORD, 1, (key % np.uint64(self.buckets)).astype(np.int64), key)
        d = np.array([0.0, *self.d_word])[np.minimum(before, 3)]
        low = (before - d) / max(self.types, 1) + self.rest / (self.vocabulary + 1)
        d1 = 1.0 if self.min_count > 1 else self.d_gram[0]
        free = d1 * once + self.d_gram[1] * twice + self.d_gram[2] * more
        return count, low, total, np.where(total > 0, free / np.maximum(total, 1), 1.0)

    def log10(self, texts: list[bytes | None]):
        """For each text: n_tokens, n_known, base score, score."""
        toks, lengths = tokens(texts)
        first = np.cumsum(lengths) - lengths
        words, at = np.unique(np.concatenate([toks, np.array([_START])]), return_inverse=True)
        count, low, total, back = self.word_figures(words)
        context = np.empty_like(at[:-1])
        context[1:] = at[:-2]
        context[first] = at[-1]
        at = at[:-1]
        keys = gram_keys(words[context], toks)
        distinct, one, inverse = np.unique(keys, return_index=True, return_inverse=True)
        (seen,) = _lookup(self.uri, self.grams, _GRAM, self.pieces, _grams_bucket(words[context[one]], distinct, self.heavy, self.buckets), distinct)
        c = seen[inverse]
        d = np.array([0.0, *self.d_gram])[np.minimum(c, 3)]
        p = (c - d) / np.maximum(total[context], 1) + back[context] * low[at]
        base = np.log10((count[at] + 1) / (self.train_tokens + self.vocabulary + 1))
        return lengths, np.add.reduceat((count[at] > 0).astype(np.int64), first), np.add.reduceat(base, first), np.add.reduceat(np.log10(p), first)


def _heavy_contexts(texts: DataFrame, buckets: int) -> np.ndarray:
    """Words with over 1/(HEAVY_SHARE * buckets) of all tokens: fewer than HEAVY_SHARE * buckets of them."""

    def count(batches):
        for part in slices(batches, "text", SLICE_BYTES):
            toks, _ = tokens(part.column("text").to_pylist())
            key, n = np.unique(toks, return_counts=True)
            keep = n >= max(2, len(toks) // (2 * HEAVY_SHARE * buckets))
            rest = n[~keep].sum()
            key, n = np.concatenate([key[keep], key[:1]]), np.concatenate([n[keep], [rest]])
            other = np.arange(len(key)) == len(key) - 1
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(n.astype(np.int64)), pa.array(other)], ["key", "n", "other"])

    counts = written(arrow_map(texts.select("text"), count, "key long, n long, other boolean").groupBy("key", "other").agg(F.sum("n").alias("n")), "lm-heavy")
    all_tokens = counts.agg(F.sum("n")).first()[0] or 0
    rows = counts.where(~F.col("other") & (F.col("n") > F.lit(all_tokens / (HEAVY_SHARE * buckets)))).select("key").collect()
    starts = np.array([_START])
    return np.unique(np.concatenate([np.array([r[0] for r in rows], np.int64).view(np.uint64), starts]))


def fit(docs: DataFrame, min_count: int = MIN_COUNT, bucket_grams: int = BUCKET_GRAMS, fan_out: int = FAN_OUT) -> Model:
    """Count ``docs`` (doc_id, text) and write the model to the shared folder."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cells = max(parts, -(-input_bytes(docs) // bucket_grams))
    pieces = -(-cells // fan_out)
    buckets = -(-cells // pieces)
    texts = docs.select(F.col("text").cast("binary").alias("text"))
    heavy = _heavy_contexts(texts, buckets)
    uri = shared_path(spark, "lm-model")

    def count(batches):
        for part in slices(batches, "text", SLICE_BYTES):
            toks, lengths = tokens(part.column("text").to_pylist())
            before = _contexts(toks, lengths)
            keys, one, n = np.unique(gram_keys(before, toks), return_index=True, return_counts=True)
            c, w = before[one], toks[one]
            order = np.lexsort((w, c))
            yield from batched(_blobs(_grams_bucket(c, keys, heavy, buckets)[order], [c[order], w[order], n[order]], 0))

    def batched(rows):
        rows = list(rows)
        for k in range(0, len(rows), 256):
            yield _batch(rows[k : k + 256])

    def regroup(batches):
        """The second deal: a bucket's bigrams, put together by their ranges of hashes."""
        for bucket, blobs in gathered(batches):
            c, w, n = (np.concatenate(x) for x in zip(*(_unpack(b, 3) for b in blobs)))
            piece = _piece(gram_keys(c, w), pieces)
            yield from batched((bucket, p, blob) for p, _, blob in _blobs(piece, [c, w, n], 0))

    def gathered(batches, most: int = 64 << 20):
        """(bucket, blobs), in several turns where a bucket holds more than ``most`` packed bytes."""
        at, blobs, size = None, [], 0
        for batch in batches:
            for bucket, blob in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if blobs and (bucket != at or size + len(blob) > most):
                    yield at, blobs
                    blobs, size = [], 0
                at, size = bucket, size + len(blob)
                blobs.append(blob)
        if blobs:
            yield at, blobs

    def add(batches):
        """Rows in order of bucket and piece: a piece is added up in memory and appended to its bucket's file."""
        at, blobs, file, figures = None, [], None, None
        for batch in batches:
            for bucket, piece, blob in zip(*(batch.column(k).to_pylist() for k in range(3))):
                if at is not None and at != (bucket, piece):
                    yield from total(*at, blobs, file, figures)
                    blobs = []
                if file is None or at[0] != bucket:
                    if file is not None:
                        yield closed(at[0], file, figures)
                    file, figures = _File(uri, f"grams-{bucket}"), [0] * 5
                at = (bucket, piece)
                blobs.append(blob)
        if file is not None:
            yield from total(*at, blobs, file, figures)
            yield closed(at[0], file, figures)

    def closed(bucket, file, figures):
        return _batch([(-1 - bucket, 0, json.dumps([bucket, file.close(), *figures, 0, 0, 0]).encode())])

    def total(bucket, piece, blobs, file, figures):
        c, w, n = (np.concatenate(x) for x in zip(*(_unpack(b, 3) for b in blobs)))
        key = gram_keys(c, w)
        order = np.argsort(key)
        key, c, w, n = key[order], c[order], w[order], n[order]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        key, c, w, n = key[first], c[first], w[first], np.add.reduceat(n.astype(np.int64), first)
        keep = n >= min_count
        file.add(piece, [key[keep], n[keep]])
        figures[:] = [a + b for a, b in zip(figures, [int(keep.sum()), *(int((n == k).sum()) for k in (1, 2, 3, 4))])]
        k2, (cnt, bef) = _sums(w, [n, np.ones(len(n), np.int64)])
        k1, (tot, s1, s2, s3) = _sums(c, [n, n == 1, n == 2, n > 2])
        yield from batched([*_blobs((k2 % np.uint64(buckets)).astype(np.int64), [k2, cnt, bef], 1), *_blobs((k1 % np.uint64(buckets)).astype(np.int64), [k1, tot, s1, s2, s3], 2)])

    def gather(batches):
        at, held = None, []
        for batch in batches:
            for bucket, kind, blob in zip(*(batch.column(k).to_pylist() for k in range(3))):
                if bucket < 0:
                    yield manifest(0, *json.loads(blob))
                    continue
                if bucket != at and held:
                    yield words(at, held)
                    held = []
                at = bucket
                held.append((kind, blob))
        if held:
            yield words(at, held)

    def words(bucket, held):
        as_word, as_context = ([_unpack(b, columns) for kind, b in held if kind == of] for of, columns in ((1, 3), (2, 5)))
        cat = lambda rows, k: np.concatenate([np.asarray(r[k], np.uint64) for r in rows]) if rows else np.zeros(0, np.uint64)
        keys = np.concatenate([cat(as_word, 0), cat(as_context, 0)])
        none_w, none_c = np.zeros(len(cat(as_word, 0)), np.int64), np.zeros(len(cat(as_context, 0)), np.int64)
        columns = [np.concatenate([cat(as_word, k).astype(np.int64), none_c]) for k in (1, 2)] + [np.concatenate([none_w, cat(as_context, k).astype(np.int64)]) for k in (1, 2, 3, 4)]
        key, sums = _sums(keys, columns)
        file = _File(uri, f"words-{bucket}")
        file.add(0, [key, *sums])
        count_, before = sums[0], sums[1]
        return manifest(1, bucket, file.close(), len(key), *(int((before == k).sum()) for k in (1, 2, 3, 4)), int(count_.sum()), int((count_ > 0).sum()), int(before.sum()))

    def manifest(kind, bucket, file, n, n1, n2, n3, n4, toks, types, before):
        names = ["kind", "bucket", "file", "n", "n1", "n2", "n3", "n4", "tokens", "types", "before"]
        values = [kind, bucket, file, n, n1, n2, n3, n4, toks, types, before]
        return pa.RecordBatch.from_arrays([pa.array([v], pa.string() if k == "file" else pa.int32() if k in ("kind", "bucket") else pa.int64()) for k, v in zip(names, values)], names)

    schema = "bucket int, kind int, blob binary"
    counted = deal(arrow_map(texts, count, schema), parts, "bucket").sortWithinPartitions("bucket", "kind")
    if pieces > 1:
        counted = deal(arrow_map(counted, regroup, schema), parts, "bucket").sortWithinPartitions("bucket", "kind")
    dealt = deal(arrow_map(counted, add, schema), parts, "bucket").sortWithinPartitions("bucket")
    rows = written(arrow_map(dealt, gather, "kind int, bucket int, file string, n long, n1 long, n2 long, n3 long, n4 long, tokens long, types long, before long"), "lm-manifest")
    return Model(uri, buckets, pieces, heavy, [r.asDict() for r in rows.collect()], min_count)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score) of every row of ``docs``."""

    def run(batches):
        for part in slices(batches, "text", SLICE_BYTES):
            n, known, base, full = model.log10(part.column("text").to_pylist())
            columns = [part.column("doc_id"), pa.array(n), pa.array(known), pa.array(np.full(len(n), model.train_tokens, np.int64)), pa.array(base), pa.array(full)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return arrow_map(rows, run, "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double")
