import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from papyra.llm import decontam, knlm, puquality, toxicity
from papyra.llm.common import fold
from papyra.llm.queries import op8_kneser_ney_lm_scoring
from pyspark.sql import functions as F


def held(doc_id, parts, k):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % parts == k


def test_fold(docs, rows):
    got = Counter((r["doc_id"], r["h"]) for r in docs.select("doc_id", (fold(F.col("doc_id"), 7) == 2).alias("h")).collect())
    assert got == Counter((r[0], held(r[0], 7, 2)) for r in rows)


def test_language_model(docs, rows, none):
    train = [r for r in rows if not held(r[0], 7, 2)]
    toks = lambda t: [*(t or "").encode().lower().split(), "END"]
    counts, pairs = Counter(), Counter()
    for r in train:
        t = toks(r[1])
        counts.update(t)
        pairs.update(zip(["START", *t], t))
    before, total = Counter(b for _, b in pairs), Counter()
    spread = {}
    for (a, _), c in pairs.items():
        total[a] += c
        spread.setdefault(a, [0, 0, 0])[min(c, 3) - 1] += 1

    def discounts(values):
        n = [sum(v == k for v in values) for k in (1, 2, 3, 4)]
        return [0, *knlm._discounts(n)]

    dg, dw = discounts(pairs.values()), discounts(before.values())
    types, v, n = len(pairs), len(counts), sum(counts.values())
    rest = sum(dw[min(x, 3)] for x in before.values()) / types
    low = lambda w: (before[w] - dw[min(before[w], 3)]) / types + rest / (v + 1)

    def p(a, w):
        c = pairs[a, w] if pairs[a, w] > 1 else 0
        s = spread.get(a, [0, 0, 0])
        back = (s[0] + dg[2] * s[1] + dg[3] * s[2]) / total[a] if total[a] else 1
        return (c - dg[min(c, 3)]) / max(total[a], 1) + back * low(w)

    for context in ("START", b"wort", b"never seen"):
        assert math.isclose(sum(p(context, w) for w in counts) + p(context, b"\0"), 1)
    held_out = fold(F.col("doc_id"), 7) == 2
    got = knlm.score(docs, knlm.fit(docs.where(~held_out), min_count=2, bucket_grams=200)).collect()
    want = {}
    for r in rows:
        t = toks(r[1])
        want[r[0], len(t)] = (sum(w in counts for w in t), sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in t), sum(math.log10(p(a, w)) for a, w in zip(["START", *t], t)))
    for r in got:
        known, base, full = want[r["doc_id"], r["n_tokens"]]
        assert r["n_known"] == known and r["train_tokens"] == n and math.isclose(r["base_score"], base, rel_tol=1e-9) and math.isclose(r["score"], full, rel_tol=1e-9)
    assert len(got) == len(rows)
    empty = knlm.score(docs.limit(3), knlm.fit(none)).collect()
    assert all(r["score"] == 0 and r["train_tokens"] == 0 for r in empty)


def test_query_scores_bigrams_seen_once(docs, rows, tmp_path):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    toks = lambda t: ["START", *(t or "").encode().lower().split(), "END"]
    pairs = Counter(p for r in rows if not held(r[0], 7, 2) for p in zip(toks(r[1]), toks(r[1])[1:]))
    before = Counter(w for _, w in pairs)
    discounts = lambda values: [0, *knlm._discounts([list(values).count(k) for k in (1, 2, 3, 4)])]
    dg, dw = discounts(pairs.values()), discounts(before.values())
    rest = sum(dw[min(x, 3)] for x in before.values()) / len(pairs)
    total, free = Counter(), Counter()
    for (a, _), c in pairs.items():
        total[a] += c
        free[a] += dg[min(c, 3)]

    def p(a, w):
        low = (before[w] - dw[min(before[w], 3)]) / len(pairs) + rest / (len(before) + 1)
        return (pairs[a, w] - dg[min(pairs[a, w], 3)] + free[a] * low) / total[a] if total[a] else low

    assert dg[1] < 1 and math.isclose(sum(p(b"wort", w) for w in before) + p(b"wort", b"\0"), 1)
    want = {(r[0], len(toks(r[1])) - 1): sum(math.log10(p(a, w)) for a, w in zip(toks(r[1]), toks(r[1])[1:])) for r in rows}
    got = op8_kneser_ney_lm_scoring(docs.sparkSession, str(tmp_path)).collect()
    assert len(got) == len(rows) and all(math.isclose(r["score"], want[r["doc_id"], r["n_tokens"]], rel_tol=1e-9) for r in got)


def test_many_buckets_pieces_and_wide_counts(spark, docs, monkeypatch):
    """10,000 buckets, and buckets of many pieces, give the scores of few; counts over 2^32 are kept."""
    score = lambda **how: {(r["doc_id"], r["n_tokens"], r["n_known"], round(r["score"], 6)) for r in knlm.score(docs, knlm.fit(docs, **how)).collect()}
    plain = score()
    assert score(bucket_grams=30, fan_out=10_000) == plain and score(bucket_grams=30, fan_out=3) == plain
    blob = knlm._pack([np.array([3, 2**33 + 1], np.uint64), np.array([2**63, 1], np.uint64), np.array([1, 1])])
    assert [c.tolist() for c in knlm._unpack(blob, 3)] == [[3, 2**33 + 1], [2**63, 1], [1, 1]] and knlm._unpack(blob, 3)[2].itemsize == 1
    # A slice in which every bigram stands 2^33 times as often: the packed rows of the first shuffle, counted up and looked up.
    pack = knlm._blobs

    def often(bucket, columns, kind):
        return pack(bucket, [*columns[:2], columns[2] * 2**33] if kind == 0 else columns, kind)

    monkeypatch.setattr(knlm, "_blobs", often)
    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(knlm)
    try:
        model = knlm.fit(spark.createDataFrame([(1, "a b a b c"), (2, "a b")], "doc_id long, text string").coalesce(1))
    finally:
        cloudpickle.unregister_pickle_by_value(knlm)
    key = np.array([int.from_bytes(knlm.xxhash.xxh3_64_digest(w), "big") for w in (b"a", b"b", b"c")], np.uint64)
    order = np.argsort(key)
    count, _, total, _ = model.word_figures(key[order])
    assert dict(zip(order.tolist(), count.tolist())) == {0: 3 * 2**33, 1: 3 * 2**33, 2: 2**33} and model.train_tokens == 9 * 2**33 and total.max() == 3 * 2**33


def distance(pattern, text):
    row = [0] * (len(text) + 1)
    for i, a in enumerate(pattern, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (a != b)))
        row = new
    return min(row)


@pytest.mark.parametrize("block_bytes", [decontam.BLOCK_CHARS, 60])
def test_decontamination_against_edit_distance(spark, monkeypatch, block_bytes):
    monkeypatch.setattr(decontam, "BLOCK_CHARS", block_bytes)
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdeé字林") for _ in range(rng.randint(1, 6)))
    items = [(i, " ".join(word() for _ in range(rng.randint(3, 25)))) for i in range(12)] + [(50, None), (51, ""), (52, "ab"), (53, "x y"), (54, "ÉÖ z"), (None, "the item without any number at all"), (55, "字林海山水木" * 4)]
    texts = []
    for k in range(60):
        t = list(items[k % 12][1])
        for _ in range(rng.randint(0, len(t) // 6)):
            at = rng.randrange(len(t))
            t[at : at + rng.randint(0, 1)] = rng.choice(["", "x", "yz", "明"])
        texts.append(f"{' '.join(word() for _ in range(rng.randint(0, 30)))}\n{''.join(t).upper() if k % 2 else ''.join(t)}  {' '.join(word() for _ in range(rng.randint(0, 30)))}")
    texts += ["cab ab", "cab", "AB", "y x  Y", "x yy", "öé éö\tz", "字林海山水木" * 3 + "字林海明水木", "字林海山水木" * 2 + "字明海明水木明", "ab " * 70_000 + items[3][1]]
    docs = [(i, t, i) for i, t in enumerate(texts)] + [(90, None, 1), (91, "", 1), (None, "see the item without any number at all", 1), (0, texts[0], 0)]
    bench = spark.createDataFrame(items, "item_id long, text string").repartition(2)
    table = spark.createDataFrame(docs, "doc_id long, text string, item_id long").repartition(2)
    got = Counter((r["doc_id"], r["item_id"], r["edits"]) for r in decontam.matches(table, bench).collect())
    want = Counter()
    for d, t, _ in docs:
        for i, x in items:
            p, s = (decontam.normalise((v or "").encode()).decode() for v in (x, t))
            if 0 < len(p) < decontam.Q:
                if f" {p} " in f" {s} ":
                    want[d, i, 0] += 1
            elif p:
                e = distance(p, s[-3000:])
                if e <= min(len(p) // 8, (len(p) - decontam.Q) // decontam.Q):
                    want[d, i, e] += 1
    assert got == want and len(want) > 30 and {52, 53, 54, 55} <= {i for _, i, _ in want}
    dirty = {d for d, _, _ in want}
    clean = decontam.clean(table, bench)
    assert clean.columns == table.columns and Counter(r["doc_id"] for r in clean.collect()) == Counter(d for d, _, _ in docs if d not in dirty)
    assert decontam.matches(table.limit(0), bench).count() == decontam.matches(table, bench.limit(0)).count() == 0


def test_many_short_documents_and_items_stay_small():
    """Memory goes with shared grams, not with documents times items."""
    import tracemalloc

    block = decontam.Block(list(range(26_000)), [b"item %06d" % i for i in range(26_000)])
    tracemalloc.start()
    found = decontam.matches_of(block, [b"text %06d here" % i for i in range(4095)] + [b"see item 000077 here"])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert (4095, 77, 0) in found and peak < 200 << 20


def test_a_very_long_item(spark):
    rng = random.Random(1)
    item = " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(1500))
    near = list(item)
    for k in range(0, len(near), 50):
        near[k] = "z"
    block = decontam.Block([1], [item.encode()])
    found = decontam.matches_of(block, [("lead " * 200_000 + "".join(near) + " tail").encode(), b"nothing"])
    assert [(k, i) for k, i, _ in found] == [(0, 1)] and 150 < found[0][2] <= 210


def classified(spark, n=400):
    rng = random.Random(1)
    docs, labels = [], []
    for i in range(n):
        words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(rng.randint(20, 80))]
        toxic, bad = i % 5 == 0, i % 7 == 0
        if toxic:
            words[3:3] = ["you", rng.choice(["idiot", "m0ron", "stupid"]), "grump" + rng.choice("abc")]
        text = " ".join(words)
        docs.append((i, " ".join(w + "!!" for w in [words[0]] * len(words)).upper() if bad else text, "en"))
        labels.append((i, int(not bad), int(toxic and not bad), "x"))
    docs += [(900, None, None), (901, "", "en"), (None, "a b", "en"), (3, docs[3][1], "en"), (902, "long " * 50_000, "en")]
    labels += [(10, None, None, "x"), (None, 1, 1, "x"), (20, 0, 0, "x"), (20, 1, 1, "x"), (1, 1, 0, "x")]
    return spark.createDataFrame(docs, "doc_id long, text string, score string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int, text string"), docs, {r[0]: r for r in labels[:n]}


def test_toxicity(spark):
    table, labels, docs, truth = classified(spark)
    scorer = toxicity.fit(table, labels)
    got = toxicity.score(table, scorer).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(d[0] for d in docs) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got)
    out = [r for r in got if r["held_out"] and r["doc_id"] in truth]
    assert all(r["held_out"] == held(r["doc_id"], 4, 2) for r in got)
    assert np.mean([r["predicted"] == truth[r["doc_id"]][2] for r in out]) > 0.95
    again = toxicity.score(table, toxicity.fit(table, labels)).collect()
    assert {(r["doc_id"], r["score"]) for r in again} == {(r["doc_id"], r["score"]) for r in got}
    # Labels of the held-out fold change nothing.
    flipped = labels.withColumn("toxic", F.when(fold(F.col("doc_id"), 4) == 2, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert {(r["doc_id"], r["score"]) for r in toxicity.score(table, toxicity.fit(table, flipped)).collect()} == {(r["doc_id"], r["score"]) for r in got}


def test_classifiers_without_labels_or_rows(spark):
    table, labels, docs, _ = classified(spark, 30)
    assert {r["score"] for r in toxicity.score(table, toxicity.fit(table, labels.limit(0))).collect()} == {0.0}
    assert {r["score"] for r in toxicity.score(table, toxicity.fit(table, labels.where("toxic = 1"))).collect()} == {1.0}
    assert {r["score"] for r in toxicity.score(table, puquality.fit(table, labels.limit(0)), 5, 0).collect()} == {0.0}
    assert toxicity.score(table.limit(0), toxicity.fit(table.limit(0), labels)).count() == 0
    assert toxicity.score(table.limit(0), puquality.fit(table.limit(0), labels), 5, 0).count() == 0


def test_quality(spark):
    table, labels, docs, truth = classified(spark)
    scorer = puquality.fit(table, labels)
    got = toxicity.score(table, scorer, puquality.FOLDS, puquality.HELD_OUT).collect()
    out = [r for r in got if r["held_out"] and r["doc_id"] in truth]
    assert all(r["held_out"] == held(r["doc_id"], 5, 0) for r in got)
    assert np.mean([r["predicted"] == truth[r["doc_id"]][1] for r in out]) > 0.95
    kept = puquality.keep_good(table, scorer)
    assert kept.columns == table.columns and Counter(r["doc_id"] for r in kept.collect()) == Counter(r["doc_id"] for r in got if r["predicted"])


def test_pu_risk_and_gradients(spark):
    """The non-negative risk by its definition, and its gradients by differences; a negative part below zero is turned round."""
    rng = np.random.default_rng(3)
    p, u = rng.normal(0.6, 1, (40, 3)), rng.normal(-0.2, 1, (70, 3))
    network = puquality.Network(np.concatenate([p, u]))
    zp, zu = network.prepared(p), network.prepared(u)
    log_loss = lambda z, y: float(np.mean([math.log1p(math.exp(-v if y else v)) for v in network.logit(z)]))
    for prior, turned in ((0.3, False), (0.98, True)):
        if turned:
            network.w[3] = network.w[3] + 3.0
            zu = zu - 2.0
        positive, negative, grads = network.risk(zp, zu, prior)
        assert math.isclose(positive, prior * log_loss(zp, True)) and math.isclose(negative, log_loss(zu, False) - prior * log_loss(zp, False))
        assert (negative < 0) == turned
        whole = lambda: -network.risk(zp, zu, prior)[1] if turned else sum(network.risk(zp, zu, prior)[:2])  # noqa: B023, E731
        for k, g in enumerate(grads):
            for at in list(np.ndindex(network.w[k].shape))[:: max(1, network.w[k].size // 7)]:
                kept = network.w[k][at]
                network.w[k][at] = kept + 1e-5
                up = whole()
                network.w[k][at] = kept - 1e-5
                down = whole()
                network.w[k][at] = kept
                assert math.isclose((up - down) / 2e-5, g[at], rel_tol=1e-4, abs_tol=1e-7)


def test_prior_from_positives_and_unlabelled():
    rng = np.random.default_rng(5)
    for prior in (0.2, 0.5, 0.85):
        good, bad = rng.normal(1.5, 1, (3000, 4)), rng.normal(-1.5, 1, (3000, 4))
        unlabelled = np.where(rng.random((3000, 1)) < prior, rng.normal(1.5, 1, (3000, 4)), bad)
        assert abs(puquality.estimated_prior(good, unlabelled) - prior) < 0.05
    scores = np.concatenate([np.ones(50), np.zeros(50)])
    assert puquality.least_quotient(np.ones(100), scores) == 0.5 and puquality.least_quotient(scores, scores) == 1.0


def test_held_out_and_negative_labels_change_nothing(spark):
    table, labels, _, _ = classified(spark)
    got = {(r["doc_id"], r["score"]) for r in toxicity.score(table, puquality.fit(table, labels), 5, 0).collect()}
    other = labels.withColumn("quality", F.when(fold(F.col("doc_id"), 5) == 0, 1 - F.col("quality")).otherwise(F.when(F.col("quality") == 1, 1)))
    again = {(r["doc_id"], r["score"]) for r in toxicity.score(table.repartition(4), puquality.fit(table.repartition(3), other.where("doc_id <> 20")), 5, 0).collect()}
    assert got == again


def test_repeated_rows_are_learned_from_once(spark):
    """A document that stands there a thousand times more changes no score, and one row of it reaches the driver."""
    table, labels, _, _ = classified(spark)
    more = table.union(table.where("doc_id in (8, 15)").crossJoin(spark.range(500)).select(table.columns))
    for module, folds in ((toxicity, (4, 2)), (puquality, (5, 0))):
        one, two = ({(r["doc_id"], r["score"]) for r in toxicity.score(table, module.fit(t, labels), *folds).collect()} for t in (table, more))
        assert one == two


def naive_boosting(x, y, weight, trees):
    """Boosted trees with every cut of every feature tried in turn."""
    share = sum(w * v for w, v in zip(weight, y)) / sum(weight)
    start = math.log(share / (1 - share))
    edges = [sorted(set(np.quantile(x[:, f], np.linspace(0, 1, trees.bins + 1)[1:-1]).tolist())) for f in range(x.shape[1])]
    total = [start] * len(y)
    for _ in range(trees.rounds):
        p = [1 / (1 + math.exp(-t)) for t in total]
        g, h = [w * (a - b) for w, a, b in zip(weight, p, y)], [w * max(a * (1 - a), 1e-6) for w, a in zip(weight, p)]
        leaves = [list(range(len(y)))]
        for _ in range(trees.depth):
            new = []
            for rows in leaves:
                best = (1e-9, None, None)
                G, H = sum(g[i] for i in rows), sum(h[i] for i in rows)
                for f in range(x.shape[1]):
                    for c in edges[f]:
                        left = [i for i in rows if x[i, f] <= c]
                        gl, hl = sum(g[i] for i in left), sum(h[i] for i in left)
                        if hl < 1 or H - hl < 1:
                            continue
                        gain = gl**2 / (hl + trees.ridge) + (G - gl) ** 2 / (H - hl + trees.ridge) - G**2 / (H + trees.ridge)
                        if gain > best[0] + 1e-9:
                            best = (gain, f, c)
                keep = [i for i in rows if best[1] is None or x[i, best[1]] <= best[2]]
                new += [keep, [i for i in rows if i not in set(keep)]]
            leaves = new
        for rows in leaves:
            value = -trees.rate * sum(g[i] for i in rows) / (sum(h[i] for i in rows) + trees.ridge)
            for i in rows:
                total[i] += value
    return np.array(total)


def test_trees_against_every_cut():
    rng = np.random.default_rng(8)
    x = rng.normal(size=(120, 3)).round(2)
    y = ((x[:, 0] > 0.2) ^ (x[:, 1] > 0.5)).astype(float)
    weight = rng.integers(1, 4, 120).astype(float)
    trees = toxicity.Trees(rounds=4, depth=2, rate=0.3, bins=8)
    assert np.allclose(trees.fit(x, y, weight).raw(x), naive_boosting(x, y, weight, trees))
    flat = toxicity.Trees(rounds=2, depth=2).fit(np.zeros((9, 2)), np.array([0, 1] * 4 + [0.0]), np.ones(9))
    assert np.allclose(flat.raw(np.zeros((1, 2))), flat.raw(np.ones((1, 2))))


def test_features_by_hand():
    """Dense features of short texts, counted by hand."""
    f = dict(zip(toxicity.NAMES, toxicity.features(b"YOU are an idiot, id1ot! i d i o t??", toxicity.Stems({"idio": 2.0}))))
    words = 10
    assert math.isclose(f["words"], math.log1p(words)) and math.isclose(f["insults"], 100 / words) and math.isclose(f["second"], 100 / words)
    assert (f["near"], f["stretch"], f["leet_hits"]) == (1, 1, 1) and math.isclose(f["stems"], 100 / words) and math.isclose(f["odds"], 200 / words)
    assert math.isclose(f["exclaims"], 1 / words) and math.isclose(f["questions"], 2 / words) and math.isclose(f["capitals"], 3 / 22)
    q = dict(zip(puquality.NAMES, puquality.features(b"a a a bb CC. 12\nx | y\nx | y")))
    assert math.isclose(q["words"], math.log1p(12)) and q["twins"] == 2 / 12 and q["distinct"] == 7 / 12 and q["lines"] == 3 / 12 and math.isclose(q["dup_lines"], 1 / 3) and q["ends"] == 0.0 and q["bars"] == 2 / 12


def test_isotonic_is_the_least_squares_fit():
    rng = np.random.default_rng(0)
    raw, y = rng.normal(size=60), rng.integers(0, 2, 60).astype(float)
    knots, values = toxicity.isotonic(raw, y, np.ones(60))
    assert (np.diff(values) > 0).all() and (np.diff(knots) > 0).all()
    # The classic bound: every pool's value is max over starts of min over ends of means.
    s = y[np.argsort(raw)]
    want = [max(min(s[a : b + 1].mean() for b in range(i, 60)) for a in range(i + 1)) for i in range(60)]
    assert np.allclose(sorted(set(np.round(want, 9))), np.round(values, 9))
