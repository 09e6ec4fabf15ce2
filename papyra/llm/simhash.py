"""SimHash near-duplicates: tiled exact comparison of 64-bit fingerprints.

Equal fingerprints first fall together in one aggregation, so a group of exact copies, however large,
is one fingerprint. Distinct fingerprints are dealt to tiles by the population counts of their four
16-bit words. Two fingerprints within ``radius`` bits have tiles whose counts differ by ``radius`` in
sum at most, so all other pairs of tiles are skipped without loss. Inside a tile, numpy exclusive-or and
bit counts compare blocks of home fingerprints with blocks of visitors. A tile with more homes than
``tile_rows`` is cut into chunks, each compared with the rest. A task emits a spanning set of links,
not all pairs, and components come from alternating stars.

Nulls and empties: a null or empty text has fingerprint zero and is linked like any other; a null doc_id
is kept and never chosen as component_id unless all ids of the component are null. Repeated rows are
repeated in the result. Extra columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from papyra.llm.common import arrow_map
from papyra.operators.graph import connected_components
from papyra.shared import written

SHINGLE, SEED, RADIUS, TILE_ROWS = 3, 42, 2, 4096
_SIDE = 17  # population counts of a 16-bit word


def fingerprint(text: bytes | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Unsigned 64-bit SimHash of a text's word shingles, each shingle as often as it stands there."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    parts = [words[i:] for i in range(shingle)] if len(words) >= shingle else [[w] for w in words]
    digest = xxhash.xxh64_digest
    hashes = b"".join([digest(b" ".join(t), seed) for t in zip(*parts)])
    bits = np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1)
    ones = bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(bits)).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """(doc_id, fp): one row per document, fp as a signed long."""

    def run(batches):
        for batch in batches:
            fps = np.array([fingerprint(t, shingle, seed) for t in batch.column(1).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps)], ["doc_id", "fp"])

    return arrow_map(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text")), run, "doc_id long, fp long")


def _tile_column(fp):
    word = lambda k: F.bit_count(F.shiftrightunsigned(fp, 16 * k).bitwiseAND(F.lit(0xFFFF)))
    return [word(k).cast("int") for k in range(4)]


def _offsets(radius: int) -> list[tuple[int, ...]]:
    """Half of the tile steps within ``radius`` in sum: each unordered pair of tiles once, without the step to itself."""
    steps = [d for d in itertools.product(range(-radius, radius + 1), repeat=4) if 0 < sum(map(abs, d)) <= radius]
    return [d for d in steps if d > tuple(-x for x in d)]


class _Homes:
    """The home fingerprints of one chunk of a tile, with their links so far."""

    def __init__(self, fps: np.ndarray, radius: int):
        self.fps, self.radius, self.root = fps, radius, np.arange(len(fps))
        self.links: list[tuple[np.ndarray, np.ndarray]] = []

    def _find(self, i: int) -> int:
        root = self.root
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    def _join(self, x: np.ndarray, y: np.ndarray) -> None:
        code = np.unique(np.minimum(x, y) * len(self.fps) + np.maximum(x, y))
        for a, b in zip((code // len(self.fps)).tolist(), (code % len(self.fps)).tolist()):
            ra, rb = self._find(a), self._find(b)
            if ra != rb:
                self.root[max(ra, rb)] = min(ra, rb)

    def among(self, block: int = 512) -> None:
        for s in range(0, len(self.fps), block):
            near = np.bitwise_count(self.fps[s : s + block, None] ^ self.fps[None, s:]) <= self.radius
            x, y = np.nonzero(near)
            keep = y > x
            self._join(x[keep] + s, y[keep] + s)

    def visit(self, fps: np.ndarray, block: int = 512) -> None:
        for s in range(0, len(fps), block):
            part = fps[s : s + block]
            x, y = np.nonzero(np.bitwise_count(part[:, None] ^ self.fps[None, :]) <= self.radius)
            if not len(x):
                continue
            visitors, first = np.unique(x, return_index=True)
            self.links.append((part[visitors], self.fps[y[first]]))
            lead = np.zeros(len(part), np.int64)
            lead[visitors] = y[first]
            more = lead[x] != y
            self._join(lead[x[more]], y[more])

    def edges(self) -> tuple[np.ndarray, np.ndarray]:
        own = np.nonzero(self.root != np.arange(len(self.fps)))[0]
        found = [*self.links, (self.fps[own], self.fps[self.root[own]])]
        return np.concatenate([a for a, _ in found]), np.concatenate([b for _, b in found])


def links(fps: DataFrame, radius: int = RADIUS, tile_rows: int = TILE_ROWS) -> DataFrame:
    """(a, b): links that span every component of the distinct values ``fp`` under ``radius`` bits."""
    spark = fps.sparkSession
    p = [F.col(f"p{k}") for k in range(4)]
    number = lambda c: ((c[0] * _SIDE + c[1]) * _SIDE + c[2]) * _SIDE + c[3]
    tiled = fps.select("fp", *[c.alias(f"p{k}") for k, c in enumerate(_tile_column(F.col("fp")))]).withColumn("tile", number(p))
    # At most 17^4 rows: the size of this table is bounded by the fingerprint's width, not by the data.
    chunks = F.broadcast(tiled.groupBy("tile").agg(F.ceil(F.count("*") / F.lit(tile_rows)).cast("int").alias("chunks")))
    home = tiled.join(chunks, "tile").withColumn("chunk", F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int"))
    steps = [F.struct(*[(p[k] + d[k]).alias(f"p{k}") for k in range(4)]) for d in _offsets(radius)]
    away = tiled.select("fp", F.explode(F.array(*steps)).alias("s"))
    for k in range(4):
        away = away.where(F.col(f"s.p{k}").between(0, 16))
    away = away.select("fp", number([F.col(f"s.p{k}") for k in range(4)]).alias("tile")).join(chunks, "tile")
    away = away.select("fp", "tile", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"))
    peers = home.where("chunk > 0").select("fp", "tile", F.explode(F.sequence(F.lit(0), F.col("chunk") - 1)).alias("chunk"))
    rows = home.select("tile", "chunk", F.lit(0).alias("role"), "fp").unionByName(away.unionByName(peers).select("tile", "chunk", F.lit(1).alias("role"), "fp"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartition(parts, "tile", "chunk").sortWithinPartitions("tile", "chunk", "role")

    def run(batches):
        at, waiting, homes = None, [], None
        for batch in batches:
            tile, chunk, role = (batch.column(k).to_numpy().astype(np.int64) for k in range(3))
            fp = batch.column(3).to_numpy().view(np.uint64)
            key = tile << 34 | chunk << 1 | role
            cuts = (np.flatnonzero(np.diff(key)) + 1).tolist()
            for s, e in zip([0, *cuts], [*cuts, len(key)]):
                if s == e:
                    continue
                if int(key[s]) >> 1 != at:
                    yield from done(waiting, homes)
                    at, waiting, homes = int(key[s]) >> 1, [], None
                if role[s] == 0:
                    waiting.append(fp[s:e])
                elif waiting:
                    homes = homes or made(waiting)
                    homes.visit(fp[s:e])
        yield from done(waiting, homes)

    def made(waiting):
        homes = _Homes(np.concatenate(waiting), radius)
        homes.among()
        return homes

    def done(waiting, homes):
        if waiting:
            a, b = (homes or made(waiting)).edges()
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    return arrow_map(dealt, run, "a long, b long")


def _components(each: DataFrame, radius: int, tile_rows: int) -> DataFrame:
    """(fp, root, component_id) of every distinct fingerprint; root is a fingerprint of the component."""
    nodes = written(each.groupBy("fp").agg(F.min("doc_id").alias("low")), "simhash-nodes")
    roots = connected_components(links(nodes, radius, tile_rows)).withColumnRenamed("node", "fp")
    tied = nodes.join(roots, "fp").select("fp", "root", "low")
    lows = tied.groupBy("root").agg(F.min("low").alias("component_id"))
    linked = tied.join(lows, "root").select("fp", "root", "component_id")
    return nodes.join(linked, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), F.coalesce("component_id", "low").alias("component_id"))


def near_duplicates(docs: DataFrame, radius: int = RADIUS, shingle: int = SHINGLE, seed: int = SEED, tile_rows: int = TILE_ROWS) -> DataFrame:
    """(doc_id, fp, component_id): one row per document; component_id is the smallest doc_id reachable by links."""
    each = written(fingerprints(docs, shingle, seed), "simhash")
    # Written, so that both sides of the last join are plain shuffles and a group of equal fingerprints can be split.
    of = written(_components(each, radius, tile_rows), "simhash-components")
    return each.join(of, "fp", "left").select("doc_id", "fp", "component_id")


def fingerprint_text(fp):
    return F.lpad(F.lower(F.hex(fp)), 16, "0")
