import hashlib
import random
from collections import Counter

import numpy as np
import xxhash

from papyra.llm import simhash, simtiles, superkmer
from pyspark.sql import functions as F


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def components(fps, radius):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(fps):
        for j in range(i):
            if (a ^ fps[j]).bit_count() <= radius:
                root[find(i)] = find(j)
    return [find(i) for i in range(len(fps))]


def test_fingerprints_and_components(docs, rows):
    got = Counter((r["doc_id"], r["fp"] % 2**64, r["component_id"]) for r in simhash.near_duplicates(docs).collect())
    fps = [brute_fingerprint(r[1]) for r in rows]
    roots = components(fps, 2)
    low = {k: min((r[0] for r, q in zip(rows, roots) if q == k and r[0] is not None), default=None) for k in set(roots)}
    assert got == Counter((r[0], f, low[k]) for r, f, k in zip(rows, fps, roots))


def test_tiles_lose_no_link(spark):
    rng = np.random.default_rng(4)
    centres = rng.integers(0, 2**64, 150, dtype=np.uint64)
    fps = set(centres.tolist())
    for c in centres[:60].tolist():
        for _ in range(rng.integers(1, 6)):
            c ^= sum(1 << int(b) for b in rng.choice(64, rng.integers(1, 4), replace=False))
            fps.add(c)
    fps = sorted(fps)
    signed = [(f - 2**64 if f >= 2**63 else f,) for f in fps]
    for tile_rows in (4096, 2):
        edges = simhash.links(spark.createDataFrame(signed, "fp long"), 2, tile_rows).collect()
        parent = {f: f for f in fps}

        def find(f):
            while parent[f] != f:
                f = parent[f]
            return f

        for e in edges:
            a, b = e["a"] % 2**64, e["b"] % 2**64
            assert (a ^ b).bit_count() <= 4 * 64
            parent[find(a)] = find(b)
        want = components(fps, 2)
        assert len({(find(f), w) for f, w in zip(fps, want)}) == len({find(f) for f in fps}) == len(set(want))
    assert len(edges) < 3 * len(fps)


def brute_set(text, n=5):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + n]) for i in range(max(len(words) - n + 1, 1))} if words else set()


def brute_groups(texts, similarity=0.8):
    sets = [brute_set(t) for t in texts]
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if len(a & b) >= similarity * len(a | b) - 1e-9:
                root[find(i)] = find(j)
    return [find(i) for i in range(len(sets))]


def check_kept(table, given, got):
    """One row of each group, that with the least id, all columns as they were."""
    assert got.columns == table.columns and got.schema == table.schema
    roots = brute_groups([r[1] for r in given])
    low = {}
    for r, k in zip(given, roots):
        low[k] = min(low.get(k, (2, 0)), (r[0] is None, r[0] or 0))
    have = [tuple(r) for r in got.collect()]
    assert not Counter(have) - Counter(tuple(r) for r in given)
    of = {}
    for r, k in zip(given, roots):
        of.setdefault((r[0], r[1]), k)
    assert sorted((of[r[0], r[1]], (r[0] is None, r[0] or 0)) for r in have) == sorted(low.items())


def test_keep_one(docs, rows, none):
    check_kept(docs, rows, simtiles.keep_one(docs))
    check_kept(docs, rows, simtiles.keep_one(docs.repartition(2), tile_rows=7))
    assert simtiles.keep_one(none).count() == simhash.near_duplicates(none).count() == 0


def test_keep_one_on_near_copies(spark):
    """Groups of edited copies, large and small, over several tiles; chains included."""
    rng = random.Random(12)
    words = lambda n: ["".join(rng.choice("abcdefghijklm") for _ in range(6)) for _ in range(n)]
    texts = []
    for k in range(60):
        base = words(rng.randint(20, 300))
        texts.append(" ".join(base))
        for _ in range(40 if k == 0 else rng.randint(0, 4)):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 40))):
                copy[rng.randrange(len(copy))] = words(1)[0]
            texts.append(" ".join(copy))
            if rng.random() < 0.5:
                base = copy
    given = [(i, t, f"_{i}", i, "row", -i) for i, t in enumerate(texts)] + [(5, texts[5], "_5", 5, "other", 0), (None, texts[9], "x", 1, "y", 2)]
    table = spark.createDataFrame(given, "doc_id long, text string, fp string, n long, root string, id long")
    for how in ({}, {"tile_rows": 9}):
        check_kept(table, given, simtiles.keep_one(table, **how))
    sets = [simtiles.shingle_set(t.encode()) for t in texts]
    assert [len(s) for s in sets] == [len(brute_set(t)) for t in texts]
    near = sorted(brute_groups(texts))
    assert 20 < len(set(near)) < len(texts)


def brute_removed(rows, window):
    words = [(r[1] or "").encode().split() for r in rows]
    key = [2**63 - 1 if r[0] is None else r[0] for r in rows]
    first = {}
    for w, k in zip(words, key):
        for i in range(len(w) - window + 1):
            t = tuple(w[i : i + window])
            first[t] = min(first.get(t, k), k)
    out = []
    for w, k in zip(words, key):
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if first[tuple(w[i : i + window])] < k:
                gone[i : i + window] = [True] * window
        out.append([x for x, g in zip(w, gone) if not g])
    return words, out


def test_substrings(docs, rows):
    for window, bucket_bytes, heavy, fan_out in ((50, 40 << 20, 8192, 8192), (7, 2000, 8192, 8192), (50, 2000, 0, 8192), (7, 2000, 2, 5)):
        words, kept = brute_removed(rows, window)
        got = superkmer.drop_repeated(docs, window, bucket_bytes=bucket_bytes, heavy_strings=heavy, fan_out=fan_out)
        want = Counter((r[0], len(w), len(w) - len(k), hashlib.sha256(b" ".join(k)).hexdigest()) for r, w, k in zip(rows, words, kept))
        assert Counter((r["row"]["doc_id"], r["n_words"], r["n_removed"], hashlib.sha256(r["kept_text"].encode()).hexdigest()) for r in got.collect()) == want
        assert any(len(w) != len(k) for w, k in zip(words, kept))


def test_verbatim_and_columns(docs, rows, none):
    out = superkmer.drop_repeated(docs, verbatim=True)
    assert out.columns == ["row", "kept_text", "n_words", "n_removed"] and out.schema["row"].dataType.names == [c for c in docs.columns if c != "text"]
    texts = Counter(r[1] for r in rows)
    assert all(r["kept_text"] in texts for r in out.where("n_removed = 0").collect())
    clash = docs.withColumns({c: F.lit(f"own {c}") for c in ("kept_text", "n_words", "n_removed", "doc", "text_hash", "bytes", "start", "given", "c0", "a.b")})
    got = superkmer.cut_texts(clash)
    assert got.dtypes == clash.dtypes
    words, kept = brute_removed(rows, 50)
    want = Counter()
    for r, w, k in zip(rows, words, kept):
        text = r[1] if len(w) == len(k) else b" ".join(k).decode()
        want[(r[0], text, *r[2:4], r[4] if len(w) == len(k) else len(text), *r[5:], *(f"own {c}" for c in clash.columns[len(r) :]))] += 1
    assert Counter(tuple(r) for r in got.collect()) == want
    assert superkmer.drop_repeated(none).count() == 0


def test_documents_without_id_are_dealt_evenly(spark):
    rng = random.Random(2)
    table = spark.createDataFrame([(None, " ".join(rng.choice("abcdefgh") for _ in range(60)) + f" {i}") for i in range(400)], "doc_id long, text string")
    parts = superkmer.drop_repeated(table).groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in parts) == 400 and max(r["count"] for r in parts) < 300


def test_windows_with_one_hash_are_told_apart(monkeypatch):
    """With all windows under one hash, words decide."""
    monkeypatch.setattr(superkmer, "_run_hashes", lambda h, width: np.zeros(max(len(h) - width + 1, 0), np.uint64))
    texts = {1: b"a b c d e", 2: b"x a b c y", 3: b"a b d c e"}
    batch = [superkmer._Batch() for _ in texts]
    for b, (doc, t) in zip(batch, texts.items()):
        found = superkmer._SuperKmers([t], 3, 2)
        for start, begin, end in zip(found.start.tolist(), found.begin.tolist(), found.end.tolist()):
            b.add(doc, doc, start, 0, found.packed(begin, end), end - begin)
    blobs = [blob for b in batch for _, blob in b.rows(1, 1)]
    found = [tuple(x.tolist() for x in part) for part in superkmer._bucket_ranges(blobs, 3)]
    assert found == [([2], [2], [1], [4])]
