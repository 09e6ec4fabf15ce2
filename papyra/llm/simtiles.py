"""Near-duplicates at a similarity of word-shingle sets: wide SimHash fingerprints compared in tiles, then an exact check.

A text's set of distinct ``shingle``-word shingles (lower-cased; fewer words: the whole sequence) gives a fingerprint of 256 bits.
Equal fingerprints are one node. Nodes are put in order of the size of their sets and cut into tiles, stored as arrays
in the shared folder. Tasks are pairs of tiles: numpy exclusive-or and bit counts compare every node of one with every
node of the other. Pairs of tiles are skipped whose population counts rule out a link: those of the sets (sets of
similarity s have sizes within the factor s) and those of the fingerprints (beyond the radius). Only nodes
with a partner within ``radius`` bits go on. At a similarity of 0.8 fingerprints differ in 39 of 256 bits on average,
with a deviation of 6, so a radius of 56 misses about one pair in a thousand there, and fewer above. The first 128 bits are compared
first; where over ``FIRST`` of them differ (of pairs at the radius 28 do on average, with a deviation of 3.3; of unlike texts 64
with one of 6) the others aren't.

Of the nodes that go on, one text each gives its set of shingle hashes; they are tiled once more, and pairs within the radius
are checked exactly, nearest first, unless they are already in one component by links checked in that tile pair. So a
task sends on a spanning set of exact links, not all pairs of a group, and no link between different texts is
lost. Components come from alternating stars.

Cost: the comparisons grow with the square of the number of distinct texts, less what sizes skip; a tile is read once for
each tile it is compared with. The driver holds one line for each tile.

Nulls and empties: a text without words has an empty set, and all of these are one group. Of each group the row with the smallest
doc_id is kept, null last; of rows that repeat it, that with the least hash of the text; of rows that repeat both, that with
the least hash of the row. All columns pass unchanged, whatever their names. An empty table gives an empty result.
"""

from __future__ import annotations

import functools
import uuid

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from papyra.llm.common import arrow_map, filesystem, slices
from papyra.operators.graph import connected_components
from papyra.shared import shared_path, written

SHINGLE, SIMILARITY, RADIUS, FIRST = 5, 0.8, 56, 48
TILE_ROWS, TILE_BYTES, SLICE_BYTES, BROADCAST_TEXTS = 16_384, 8 << 20, 4 << 20, 200_000
_WORDS = 4  # of 64 bits in a fingerprint
_LAST = (1 << 63) - 1
_C = np.uint64(0x9E3779B97F4A7C15)
_FILE = "file string, n int, low long, high long, low_bits int, high_bits int"


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: bytes | None, shingle: int = SHINGLE) -> np.ndarray:
    """Distinct 64-bit hashes of the word shingles of a text, in order."""
    words = (text or b"").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    digest = xxhash.xxh3_64_digest
    h = np.frombuffer(b"".join(map(digest, words)), ">u8").astype(np.uint64)
    width = min(shingle, len(h))
    total = np.zeros(len(h) - width + 1, np.uint64)
    for k in range(width):
        total = total * _C + h[k : len(h) - width + 1 + k]
    return np.unique(_mix(total))


def fingerprint(hashes: np.ndarray) -> bytes:
    """256 bits; each is 1 if set in over half of the hashes, which are stretched to that width."""
    ones = np.zeros(64 * _WORDS, np.int64)
    for s in range(0, len(hashes), 4096):
        part = hashes[s : s + 4096]
        wide = np.stack([_mix(part + np.uint64((k * int(_C)) % (1 << 64))) for k in range(_WORDS)], axis=1)
        ones += np.unpackbits(wide.view(np.uint8), axis=1).sum(axis=0, dtype=np.int64)
    return np.packbits(2 * ones > len(hashes)).tobytes()


def _keys(docs: DataFrame) -> list[Column]:
    return [F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("id"), F.xxhash64("text").alias("text_hash")]


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(id, text_hash, fp, n): fingerprint and size of the set of every row; a null doc_id is the largest number."""

    def run(batches):
        for part in slices(batches, "text", SLICE_BYTES):
            sets = [shingle_set(t, shingle) for t in part.column("text").to_pylist()]
            columns = [part.column("id"), part.column("text_hash"), pa.array([fingerprint(s) for s in sets], pa.binary()), pa.array([len(s) for s in sets], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "text_hash", "fp", "n"])

    rows = docs.select(*_keys(docs), F.col("text").cast("binary").alias("text"))
    return arrow_map(rows, run, "id long, text_hash long, fp binary, n long")


class _Tile:
    """Nodes of a file: fingerprints, sizes and, if stored, the sets."""

    def __init__(self, fps: np.ndarray, sizes: np.ndarray, sets: np.ndarray):
        self.fps, self.sizes, self.sets = fps, sizes, sets
        self.ends = np.cumsum(sizes)

    def save(self, uri: str) -> str:
        fs, path = filesystem(uri)
        fs.create_dir(path, recursive=True)
        file = f"tile-{uuid.uuid4().hex}"
        with fs.open_output_stream(f"{path}/{file}", compression=None) as f:
            for x in (np.array([len(self.fps)], np.int64), self.fps, self.sizes, self.sets):
                f.write(np.ascontiguousarray(x).tobytes())
        return file

    @classmethod
    def load(cls, uri: str, file: str) -> _Tile:
        fs, path = filesystem(uri)
        with fs.open_input_file(f"{path}/{file}") as f:
            raw = f.read_buffer()
        n = int(np.frombuffer(raw, np.int64, 1)[0])
        fps = np.frombuffer(raw, np.uint64, n * _WORDS, 8).reshape(n, _WORDS)
        at = 8 + fps.nbytes
        return cls(fps, np.frombuffer(raw, np.int64, n, at), np.frombuffer(raw, np.uint64, -1, at + 8 * n))

    def set_of(self, k: int) -> np.ndarray:
        return self.sets[self.ends[k] - self.sizes[k] : self.ends[k]]


def _tiles(nodes: DataFrame, uri: str, tile_rows: int) -> list:
    """Write ``nodes`` (fp, n, and hashes or null) in order of n; one line of figures for each tile, in that order."""

    def write(batches):
        held: list = []
        size = 0
        for batch in slices(batches, "hashes", TILE_BYTES):
            for fp, n, raw in zip(*(batch.column(k).to_pylist() for k in range(3))):
                if held and (len(held) >= tile_rows or size + len(raw or b"") > TILE_BYTES):
                    yield line(held)
                    held, size = [], 0
                held.append((fp, n, raw or b""))
                size += len(raw or b"")
        if held:
            yield line(held)

    def line(held):
        fps = np.frombuffer(b"".join(h[0] for h in held), np.uint64).reshape(-1, _WORDS)
        sizes = np.array([h[1] for h in held], np.int64)
        file = _Tile(fps, sizes, np.frombuffer(b"".join(h[2] for h in held), np.uint64)).save(uri)
        bits = np.bitwise_count(fps).sum(axis=1)
        values = [file, len(held), int(sizes[0]), int(sizes[-1]), int(bits.min()), int(bits.max())]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, (pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32()))], [x.split()[0] for x in _FILE.split(", ")])

    dealt = nodes.select("fp", "n", "hashes").repartitionByRange("n", "fp").sortWithinPartitions("n", "fp")
    return sorted(written(arrow_map(dealt, write, _FILE), "sim-tiles").collect(), key=lambda r: (r["low"], r["high"], r["file"]))


def _pairs(spark: SparkSession, tiles: list, similarity: float) -> DataFrame:
    """(a, b): the pairs of tiles to compare, dealt evenly. A tile's partners are a run of the tiles after it."""
    runs, end = [], 0
    for k, t in enumerate(tiles):
        end = max(end, k)
        while end + 1 < len(tiles) and similarity * tiles[end + 1]["low"] <= t["high"]:
            end += 1
        runs.append((k, end))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = spark.createDataFrame(runs, "a int, last int").select("a", F.explode(F.sequence("a", "last")).alias("b"))
    return rows.repartitionById(parts, F.pmod(F.xxhash64("a", "b"), F.lit(parts)).cast("int"))


def _near(x: _Tile, y: _Tile, same: bool, similarity: float, radius: int, first: int = FIRST, rows: int = 16, columns: int = 2048):
    """(i, j, distance) arrays of pairs within the radius whose sizes allow the similarity, block by block; j > i in one tile."""
    (x0, x1), (y0, y1) = ([np.ascontiguousarray(t.fps[:, k]) for k in (0, 1)] for t in (x, y))
    for s in range(0, len(x.fps), rows):
        low, high = np.searchsorted(y.sizes, np.ceil(similarity * x.sizes[s] - 1e-9), "left"), np.searchsorted(y.sizes, x.sizes[min(s + rows, len(x.sizes)) - 1] / similarity + 1e-9, "right")
        for t in range(max(low, s) if same else low, high, columns):
            a, b = slice(s, s + rows), slice(t, min(t + columns, high))
            bits = np.bitwise_count(x0[a, None] ^ y0[None, b])
            bits += np.bitwise_count(x1[a, None] ^ y1[None, b])
            near = np.flatnonzero(bits.ravel() <= first)
            i, j = near // bits.shape[1] + s, near % bits.shape[1] + t
            if same:
                i, j = i[j > i], j[j > i]
            if len(i):
                all_bits = np.bitwise_count(x.fps[i] ^ y.fps[j]).sum(axis=1)
                keep = all_bits <= radius
                if keep.any():
                    yield i[keep], j[keep], all_bits[keep]


@functools.lru_cache(maxsize=4)
def _loaded(uri: str, file: str) -> _Tile:
    return _Tile.load(uri, file)


def _compared(spark: SparkSession, tiles: list, uri: str, similarity: float, radius: int, found, schema: str) -> DataFrame:
    files = [(t["file"], t["low_bits"], t["high_bits"]) for t in tiles]

    def run(batches):
        for batch in batches:
            for a, b in zip(*(batch.column(k).to_pylist() for k in range(2))):
                if files[a][1] - files[b][2] > radius or files[b][1] - files[a][2] > radius:
                    continue
                x = _loaded(uri, files[a][0])
                yield from found(x, x if a == b else _loaded(uri, files[b][0]), a == b)

    return arrow_map(_pairs(spark, tiles, similarity), run, schema)


def _paired(nodes: DataFrame, similarity: float, radius: int, tile_rows: int) -> DataFrame:
    """(fp): the nodes with a partner within the radius."""
    uri = shared_path(nodes.sparkSession, "sim-nodes")
    tiles = _tiles(nodes.withColumn("hashes", F.lit(None).cast("binary")), uri, tile_rows)

    def found(x, y, same):
        left, right = np.zeros(len(x.fps), bool), np.zeros(len(y.fps), bool)
        for i, j, _ in _near(x, y, same, similarity, radius):
            left[i] = right[j] = True
        hit = np.concatenate([x.fps[left], y.fps[right]])
        if len(hit):
            yield pa.RecordBatch.from_arrays([pa.array([f.tobytes() for f in hit], pa.binary())], ["fp"])

    return written(_compared(nodes.sparkSession, tiles, uri, similarity, radius, found, "fp binary").distinct(), "sim-paired")


def alike(a: np.ndarray, b: np.ndarray, similarity: float = SIMILARITY) -> bool:
    """Whether the Jaccard similarity of two sets of sorted hashes is ``similarity`` or more; of two empty ones it is 1."""
    both = np.concatenate([a, b])
    both.sort()
    common = int((both[1:] == both[:-1]).sum())
    return common >= similarity * (len(a) + len(b) - common) - 1e-9


def links(docs: DataFrame, each: DataFrame, shingle: int, similarity: float, radius: int, tile_rows: int) -> DataFrame:
    """(a, b): fingerprints of exact links that span every component."""
    nodes = written(each.groupBy("fp").agg(F.min("n").alias("n"), F.min(F.struct("id", "text_hash")).alias("key")), "sim-nodes")
    chosen = written(nodes.join(_paired(nodes, similarity, radius, tile_rows), "fp").select("fp", "n", "key.*"), "sim-chosen")
    small = chosen.count() <= BROADCAST_TEXTS
    texts = docs.select(*_keys(docs), F.col("text").cast("binary").alias("text"))
    joined = texts.join(F.broadcast(chosen) if small else chosen, ["id", "text_hash"]).select("fp", "text")

    def sets(batches):
        for part in slices(batches, "text", SLICE_BYTES):
            found = [shingle_set(t, shingle) for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("fp"), pa.array([len(s) for s in found], pa.int64()), pa.array([s.tobytes() for s in found], pa.binary())], ["fp", "n", "hashes"])

    # Rows that repeat id and text give equal sets.
    full = arrow_map(joined, sets, "fp binary, n long, hashes binary").groupBy("fp").agg(F.min("n").alias("n"), F.min("hashes").alias("hashes"))
    full = written(full, "sim-sets")
    uri = shared_path(docs.sparkSession, "sim-tiles")
    tiles = _tiles(full, uri, tile_rows)

    def found(x, y, same):
        n = len(x.fps)
        root = list(range(n if same else n + len(y.fps)))

        def find(i):
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        edges = []
        for i, j, bits in _near(x, y, same, similarity, radius):
            shift = 0 if same else n
            (a_s, at), (b_s, to) = np.unique(i, return_inverse=True), np.unique(j, return_inverse=True)
            open_ = np.array([find(a) for a in a_s.tolist()])[at] != np.array([find(shift + b) for b in b_s.tolist()])[to]
            i, j = i[open_], j[open_]
            for k in np.argsort(bits[open_], kind="stable").tolist():
                a, b = int(i[k]), int(j[k])
                ra, rb = find(a), find(shift + b)
                if ra != rb and alike(x.set_of(a), y.set_of(b), similarity):
                    root[rb] = ra
                    edges.append((x.fps[a].tobytes(), y.fps[b].tobytes()))
        if edges:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*edges)], ["a", "b"])

    return _compared(docs.sparkSession, tiles, uri, similarity, radius, found, "a binary, b binary")


def groups(docs: DataFrame, shingle: int = SHINGLE, similarity: float = SIMILARITY, radius: int = RADIUS, tile_rows: int = TILE_ROWS) -> DataFrame:
    """(id, text_hash, root): one row per document; documents of one group have one root."""
    each = written(fingerprints(docs, shingle), "sim-each")
    roots = connected_components(links(docs, each, shingle, similarity, radius, tile_rows)).withColumnRenamed("node", "fp")
    roots = written(roots, "sim-roots")
    return each.join(roots, "fp", "left").select("id", "text_hash", F.coalesce("root", "fp").alias("root"))


def keep_one(docs: DataFrame, **how) -> DataFrame:
    """One row of each group, with all its columns."""
    least = groups(docs, **how).groupBy("root").agg(F.min(F.struct("id", "text_hash")).alias("key"))
    chosen = written(least.select("key.*").distinct(), "sim-kept")
    keyed = docs.select(*_keys(docs), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    kept = keyed.join(chosen, ["id", "text_hash"], "left_semi")
    place = F.row_number().over(Window.partitionBy("id", "text_hash").orderBy(F.xxhash64(F.to_json("row"))))
    return kept.withColumn("place", place).where("place = 1").select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
