"""Benchmark decontamination by the q-gram lemma and banded alignment.

Texts are lower-cased and their white space made single spaces; lengths, edits and q-grams are of characters (code
points). An item of n characters is found in a document if some stretch of it is within k = n/8 edits (characters inserted,
deleted or replaced). Such a stretch shares n - q + 1 - k*q q-grams with the item at least, all on k + 1
neighbouring diagonals. Shared q-grams are counted in overlapping bands of 2(k + 1) diagonals, so one band holds the whole
match; bands under the bound are dropped without loss, the others verified by alignment inside the band. Items so short that
the bound is under one gram are given the edits that leave one; items under q characters have no gram and are found as
whole words, without edits.

The items are indexed by the tasks that read the benchmark, block by block, in the shared folder; the driver holds one
name for each block. Each task reads its documents once and holds them against the blocks, so the benchmark may be of any
size. Memory grows with the q-grams that a slice shares with a block, not with documents times items. Documents aren't shuffled.

Nulls and empties: null or empty texts and items match nothing. A null doc_id or item_id is reported as null. Repeated
rows are reported as often as they stand there. Extra columns are ignored.
"""

from __future__ import annotations

import functools
import pickle
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from papyra.llm.common import arrow_map, filesystem, keep_rows, slices
from papyra.shared import shared_path, written

Q, EDITS_PER_CHAR, SLACK, BLOCK_CHARS, SLICE_BYTES = 6, 1 / 8, 16, 1 << 18, 1 << 19
CACHED_BLOCKS, WIDE_SLICE_BYTES = 16, 4 << 20  # beyond so many blocks, wider slices read each block less often
_C = np.uint64(0x9E3779B97F4A7C15)
_FILTER_BITS = 18
_GAP = 8


def normalise(text: bytes | None) -> bytes:
    return b" ".join((text or b"").decode("utf-8", "replace").lower().encode().split())


def points(text: bytes) -> np.ndarray:
    """The code points of a UTF-8 text."""
    return np.frombuffer(text.decode().encode("utf-32-le"), np.uint32)


def _codes(letters: np.ndarray) -> np.ndarray:
    """A hash of the q-gram that starts at each character; those that would run over the end are padded with zeros."""
    wide = np.concatenate([letters, np.zeros(Q - 1, np.uint32)]).astype(np.uint64)
    code = np.zeros(len(letters), np.uint64)
    for k in range(Q):
        code = code * _C + wide[k : k + len(letters)]
    return code ^ (code >> np.uint64(29))


def _slot(codes: np.ndarray) -> np.ndarray:
    return (codes * _C) >> np.uint64(64 - _FILTER_BITS)


class Block:
    """Some items with the index of their q-grams.

    An edit destroys q grams at most, so of any q * edits + 1 + SLACK grams of an item a match keeps SLACK + 1. Only
    the grams rarest in the block are indexed, that many for each item.
    """

    def __init__(self, ids: list, texts: list[bytes]):
        whole = [points(t) for t in texts]
        self.short: dict[bytes, list[tuple]] = {}
        for i, t, p in zip(ids, texts, whole):
            if 0 < len(p) < Q:
                self.short.setdefault(t.split()[0], []).append((i, t))
        self.ids, self.texts = [i for i, p in zip(ids, whole) if len(p) >= Q], [p for p in whole if len(p) >= Q]
        if not self.texts:
            return
        n = np.array([len(t) for t in self.texts], np.int64)
        self.length = n
        self.edits = np.minimum((n * EDITS_PER_CHAR).astype(np.int64), (n - Q) // Q)
        grams = [_codes(t)[: len(t) - Q + 1] for t in self.texts]
        self.grams = grams
        seen, inverse, count = np.unique(np.concatenate(grams), return_inverse=True, return_counts=True)
        often, at, code, item, place = count[inverse], 0, [], [], []
        for i, g in enumerate(grams):
            rare = np.argsort(often[at : at + len(g)], kind="stable")[: Q * int(self.edits[i]) + 1 + SLACK]
            at += len(g)
            code.append(g[rare])
            item.append(np.full(len(rare), i))
            place.append(rare)
        self.bound = np.array([len(c) for c in code]) - Q * self.edits
        code = np.concatenate(code)
        slot = _slot(code)
        order = np.argsort(slot, kind="stable")
        self.code, self.item, self.place = code[order], np.concatenate(item)[order].astype(np.int32), np.concatenate(place)[order].astype(np.int32)
        self.count = np.bincount(slot.astype(np.int64), minlength=1 << _FILTER_BITS).astype(np.int32)
        self.first = (np.cumsum(self.count) - self.count).astype(np.int32)
        self.some = self.count > 0


def _bands(block: Block, letters: np.ndarray, doc_start: np.ndarray):
    """(doc, item, first diagonal) of the bands that meet the bound."""
    codes = _codes(letters)
    slots = _slot(codes).astype(np.int32)
    at = np.flatnonzero(block.some[slots])
    slots = slots[at]
    count = block.count[slots]
    before = np.cumsum(count) - count
    grams = np.arange(count.sum(), dtype=np.int64) + np.repeat(block.first[slots] - before, count)
    at = np.repeat(at, count)
    same = block.code[grams] == codes[at]
    at, grams = at[same], grams[same]
    n_items = len(block.texts)
    doc = np.searchsorted(doc_start, at, "right") - 1
    # Only pairs that share a gram are counted.
    pairs, pair, shared = np.unique(doc * n_items + block.item[grams], return_inverse=True, return_counts=True)
    keep = (shared >= block.bound[pairs % n_items])[pair]
    pair, at, grams = pair[keep], at[keep], grams[keep]
    item = block.item[grams]
    offset = int(block.length.max())
    band = (at - block.place[grams] + offset) // (block.edits[item] + 1)
    span = np.int64(len(letters) + offset + 2)
    key = pair * span + band + 1
    key = np.concatenate([key, key - 1])
    key.sort()
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    shared = np.diff(np.concatenate([first, [len(key)]]))
    pair, band = pairs[key[first] // span], key[first] % span - 1
    item = pair % n_items
    full = shared >= block.bound[item]
    pair, band, item = pair[full], band[full], item[full]
    first = band * (block.edits[item] + 1) - offset
    lemma = np.array([_meets_lemma(block, codes, i, f) for i, f in zip(item.tolist(), first.tolist())], bool)
    return (pair // n_items)[lemma], item[lemma], first[lemma]


def _meets_lemma(block: Block, codes: np.ndarray, item: int, first: int) -> bool:
    """Whether enough of all the item's q-grams stand on the band's diagonals."""
    grams, width = block.grams[item], 2 * (int(block.edits[item]) + 1)
    low, high = max(first, 0), first + len(grams) + width - 1
    part = codes[low:high]
    if low > first or len(part) < high - low:
        part = np.concatenate([np.zeros(low - first, np.uint64), part, np.zeros(high - low - len(part), np.uint64)])
    seen = (np.lib.stride_tricks.sliding_window_view(part, width) == grams[:, None]).any(axis=1)
    return int(seen.sum()) >= len(grams) - Q * int(block.edits[item])


def banded_distance(letters: np.ndarray, low: np.ndarray, high: np.ndarray, texts: list[np.ndarray], first: np.ndarray, width: np.ndarray) -> np.ndarray:
    """For each case, the least edits between its text and any stretch of letters[low:high] along the diagonals
    first to first + width - 1, all cases at once, one character at a time."""
    n = np.array([len(t) for t in texts])
    w = int(width.max())
    column = np.arange(w)
    pattern = np.zeros((len(texts), n.max()), np.uint32)
    for c, t in enumerate(texts):
        pattern[c, : len(t)] = t
    far = np.int32(1 << 30)
    dp = np.where(column[None, :] < width[:, None], 0, far).astype(np.int32)
    best = np.full(len(texts), far, np.int32)
    for j in range(n.max()):
        place = first[:, None] + j + column[None, :]
        inside = (place >= low[:, None]) & (place < high[:, None])
        letter = letters[np.clip(place, 0, len(letters) - 1)]
        step = dp + np.where(inside & (letter == pattern[:, j, None]), 0, 1)
        step[:, :-1] = np.minimum(step[:, :-1], dp[:, 1:] + 1)
        step[column[None, :] >= width[:, None]] = far
        dp = np.minimum.accumulate(step - column[None, :], axis=1) + column[None, :]
        done = n == j + 1
        best[done] = dp[done].min(axis=1)
    return best


def matches_of(block: Block, texts: list[bytes | None]) -> list[tuple[int, int | None, int]]:
    """(place of the text, item id, edits) of every item found in every text."""
    plain = [normalise(t) for t in texts]
    found: list[tuple[int, int | None, int]] = []
    for k, text in enumerate(plain if block.short else []):
        for word in block.short.keys() & set(text.split()):
            found += [(k, i, 0) for i, t in block.short[word] if t == word or b" " + t + b" " in b" " + text + b" "]
    if not block.texts:
        return found
    whole = [points(t) for t in plain]
    gap = np.full(_GAP, 10, np.uint32)
    letters = np.concatenate([x for w in whole for x in (w, gap)]) if whole else gap
    sizes = np.array([len(w) for w in whole], np.int64)
    start = np.cumsum(sizes + _GAP) - sizes - _GAP
    doc, item, diagonal = _bands(block, letters, start)
    best: dict[tuple[int, int], int] = {}
    order = np.argsort(block.length[item], kind="stable")  # cases of like length together
    for s in range(0, len(order), 256):
        c = order[s : s + 256]
        d, i = doc[c], item[c]
        edits = banded_distance(letters, start[d], start[d] + sizes[d], [block.texts[x] for x in i.tolist()], diagonal[c], 2 * (block.edits[i] + 1))
        for a, b, e in zip(d.tolist(), i.tolist(), edits.tolist()):
            if e <= block.edits[b]:
                best[a, b] = min(e, best.get((a, b), e))
    return found + sorted((a, block.ids[b], e) for (a, b), e in best.items())


def _blocks(benchmark: DataFrame, folder: str) -> list[str]:
    """Write the index of the benchmark to the shared folder, block by block; the names of the blocks."""

    def build(batches):
        ids, texts, chars = [], [], 0
        for batch in slices(batches, "text", BLOCK_CHARS):
            for item_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                plain = normalise(text)
                if texts and chars + len(plain) > BLOCK_CHARS:
                    yield close(ids, texts)
                    ids, texts, chars = [], [], 0
                ids.append(item_id)
                texts.append(plain)
                chars += len(plain)
        if texts:
            yield close(ids, texts)

    def close(ids, texts):
        fs, path = filesystem(folder)
        fs.create_dir(path, recursive=True)
        name = f"block-{uuid.uuid4().hex}"
        with fs.open_output_stream(f"{path}/{name}", compression=None) as f:
            f.write(pickle.dumps(Block(ids, texts)))
        return pa.RecordBatch.from_arrays([pa.array([name])], ["name"])

    rows = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("binary").alias("text")).where("text is not null")
    return sorted(r["name"] for r in written(arrow_map(rows, build, "name string"), "benchmark-blocks").collect())


@functools.lru_cache(maxsize=CACHED_BLOCKS)
def _load(folder: str, name: str) -> Block:
    fs, path = filesystem(folder)
    with fs.open_input_stream(f"{path}/{name}", compression=None) as f:
        return pickle.loads(f.read())


def _found(texts: list[bytes | None], folder: str, names: list[str]) -> list[tuple[int, int | None, int]]:
    return [m for n in names for m in matches_of(_load(folder, n), texts)]


def _slice_bytes(names: list[str]) -> int:
    return SLICE_BYTES if len(names) <= CACHED_BLOCKS else WIDE_SLICE_BYTES


def matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, edits): one row for each item found in a document."""
    folder = shared_path(docs.sparkSession, "benchmark")
    names = _blocks(benchmark, folder)

    def run(batches):
        for part in slices(batches, "text", _slice_bytes(names)):
            found = _found(part.column("text").to_pylist(), folder, names)
            if found:
                ids = part.column("doc_id").take(pa.array([t for t, _, _ in found]))
                yield pa.RecordBatch.from_arrays([ids, pa.array([i for _, i, _ in found], pa.int64()), pa.array([e for _, _, e in found], pa.int64())], ["doc_id", "item_id", "edits"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return arrow_map(rows, run, "doc_id long, item_id long, edits long")


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` in which no item is found, with all their columns."""
    folder = shared_path(docs.sparkSession, "benchmark")
    names = _blocks(benchmark, folder)

    def judge(texts):
        dirty = {t for t, _, _ in _found(texts, folder, names)}
        return [k not in dirty for k in range(len(texts))]

    return keep_rows(docs, judge, _slice_bytes(names))
