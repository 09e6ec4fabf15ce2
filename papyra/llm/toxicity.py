"""Toxicity scores by gradient-boosted trees over dense features, calibrated by isotonic regression.

Features of the whole text: densities of lexicons (fixed ones, and one of word stems learned from the labels),
lexicon words near second-person words, the densest stretch, capitals, punctuation and obfuscation rates. Trees are
fitted on the driver to a bounded sample: of the labelled rows outside the held-out fold, up to
``SAMPLE_POSITIVE`` and ``SAMPLE_NEGATIVE`` with the least md5 of the id, weighted back to their true shares.
The learned lexicon is cross-fitted: a training row's densities use stems learned from the other half.
Calibration uses scores of trees that didn't see the row.

Nulls and empties: a null or empty text has zero features and gets a score like any other. Null labels and
ids with both labels aren't learned from; rows of a null doc_id are scored, with held_out false. Of rows that repeat an id that
with the least text is learned from. With labels of
one class only every score is that class; with none, 0. Extra columns are ignored, repeated rows are
repeated in the result, an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from papyra.llm.common import arrow_map, fold, slices
from papyra.llm.labelled import agreed, by_hash, with_texts
from papyra.shared import written

FOLDS, HELD_OUT, CUTOFF = 4, 2, 0.3
SAMPLE_POSITIVE, SAMPLE_NEGATIVE = 8_000, 12_000
#: Learned stems: how many at most, their lengths in letters, the fewest label-1 texts and the least log odds.
STEMS, STEM_LENGTHS, STEM_TEXTS, STEM_ODDS, STRONG = 300, range(3, 9), 8, 1.5, 3.0
SLICE_BYTES, STRETCH, NEAR = 4 << 20, 50, 5
# Words of abuse, threat and second person in four languages.
INSULTS = frozenset(
    w.encode()
    for w in (
        "idiot idiots idiotic moron morons moronic stupid stupidity dumb dumbass loser losers pathetic worthless trash scum clown clowns disgusting ugly fool fools freak garbage jerk liar imbecile cretin "
        "dimwit vermin filth filthy coward bastard bitch asshole shit crap fuck fucking fucker damn slut whore retard retarded pig swine rat scumbag lowlife weirdo creep nasty useless repulsive "
        "dummkopf dumm blöd blöde trottel arschloch abschaum wertlos ekelhaft müll versager schwein hure idiote stupide crétin imbécile connard ordure minable dégoûtant raté salaud merde pute "
        "idiota estúpido estúpida imbécil tonto tonta basura patético asqueroso inútil perdedor payaso mierda puta cabrón"
    ).split()
)
THREATS = frozenset(w.encode() for w in "kill killed die dies hurt destroy burn hang shoot stab beat punch rape murder bleed suffer töten sterben tuer mourir matar morir".split())
SECOND_PERSON = frozenset(w.encode() for w in "you your yours youre yourself u ur du dich dir dein deine deiner ihr euch tu te toi ton tes vous votre vos tú usted ustedes ti tus".split())
_PUNCTUATION = bytes(32 if chr(b) in "!\"#%&'()*+,-./:;<=>?[\\]^_`{|}~" else b for b in range(256))
_LEET = bytes.maketrans(b"@0134$5!7", b"aoieassit")
_LETTERS = np.array([chr(b).isalpha() and b < 128 for b in range(256)])
_UPPER = np.arange(65, 91)
NAMES = ["words", "insults", "insults_n", "threats", "stems", "stems_n", "strong_n", "odds", "second", "near", "stretch", "capitals", "exclaims", "questions", "stops", "digits", "symbols", "runs", "leet", "leet_hits"]


class Stems:
    """Word beginnings with the log odds of label 1 for a text that has them."""

    def __init__(self, odds: dict[str, float] | None = None):
        self.heads: dict[bytes, list[tuple[bytes, float]]] = {}
        for stem, value in (odds or {}).items():
            self.heads.setdefault(stem.encode()[:3], []).append((stem.encode(), value))

    def of(self, words: set[bytes]) -> dict[bytes, float]:
        """The largest odds of each word that begins with a stem."""
        found, heads = {}, self.heads
        for w in words:
            if (near := heads.get(w[:3])) is not None:
                odds = max((v for stem, v in near if w.startswith(stem)), default=0.0)
                if odds:
                    found[w] = odds
        return found


def _words(text: bytes) -> tuple[bytes, list[bytes]]:
    low = text.decode("utf-8", "replace").lower().encode()
    return low, low.translate(_PUNCTUATION).split()


def features(text: bytes, learned: Stems) -> list[float]:
    """The figures of ``NAMES`` for one text."""
    low, words = _words(text)
    n, size = max(len(words), 1), max(len(text), 1)
    have = set(words)
    letters = np.frombuffer(text, np.uint8)
    count = np.bincount(letters, minlength=256)
    alpha = max(int(count[_LETTERS].sum()), 1)
    insults = threats = taught = strong = near = stretch = 0
    odds = 0.0
    second = sum(w in SECOND_PERSON for w in words) if have & SECOND_PERSON else 0
    stems = learned.of(have)
    if stems or have & INSULTS or have & THREATS:
        at = [i for i, w in enumerate(words) if w in stems or w in INSULTS or w in THREATS]
        insults = sum(words[i] in INSULTS for i in at)
        threats = sum(words[i] in THREATS for i in at)
        values = [stems.get(words[i], 0.0) for i in at]
        taught, strong, odds = sum(v > 0 for v in values), sum(v >= STRONG for v in values), sum(values)
        near = sum(any(w in SECOND_PERSON for w in words[max(0, i - NEAR) : i + NEAR + 1]) for i in at) if second else 0
        place = np.array(at)
        stretch = int((np.searchsorted(place, place + STRETCH) - np.arange(len(place))).max())
    runs = leet = leet_hits = 0
    if len(letters) > 2:
        runs = int(((letters[2:] == letters[1:-1]) & (letters[1:-1] == letters[:-2]) & _LETTERS[letters[2:]]).sum())
    if count[[48, 49, 51, 52, 53, 55, 64, 36, 33]].any():
        plain = low.translate(_LEET).translate(_PUNCTUATION).split()
        fresh = set(plain) - have
        leet = sum(w in fresh and w.isalpha() for w in plain)
        leet_hits = sum(w in INSULTS or w in THREATS for w in plain if w in fresh) if fresh & (INSULTS | THREATS) else 0
    # Insults spelt with spaces or stops between the letters.
    if len(words) > 3 and sum(len(w) == 1 for w in words) > 3:
        joined, run = [], b""
        for w in [*words, b"--"]:
            if len(w) == 1:
                run += w
            else:
                joined.append(run)
                run = b""
        leet_hits += sum(w in INSULTS or w in THREATS for w in joined)
    exclaims, questions, stops = int(count[33]), int(count[63]), int(count[46] + count[44])
    digits, symbols = int(count[48:58].sum()), int(count[[35, 36, 37, 38, 42, 124, 60, 62, 64, 94, 126]].sum())
    return [
        np.log1p(len(words)), 100 * insults / n, np.log1p(insults), 100 * threats / n, 100 * taught / n, np.log1p(taught), np.log1p(strong), 100 * odds / n, 100 * second / n, near, stretch,
        int(count[_UPPER].sum()) / alpha, exclaims / n, questions / n, stops / n, digits / size, symbols / size, 100 * runs / size, 100 * leet / n, leet_hits,
    ]


def matrix(texts: list[bytes | None], learned: Stems) -> np.ndarray:
    return np.array([features(t or b"", learned) for t in texts], float).reshape(-1, len(NAMES))


class Trees:
    """Boosted trees of fixed depth for the logistic loss, on binned features."""

    def __init__(self, rounds: int = 120, depth: int = 3, rate: float = 0.1, ridge: float = 2.0, bins: int = 48):
        self.rounds, self.depth, self.rate, self.ridge, self.bins = rounds, depth, rate, ridge, bins

    def fit(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> Trees:
        share = np.clip(np.average(y, weights=weight), 1e-6, 1 - 1e-6)
        self.start = float(np.log(share / (1 - share)))
        edges = [np.unique(np.quantile(c, np.linspace(0, 1, self.bins + 1)[1:-1])) for c in x.T]
        binned = np.stack([np.searchsorted(e, c, "left") for e, c in zip(edges, x.T)], axis=1)
        total, self.trees = np.full(len(y), self.start), []
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-total))
            g, h = weight * (p - y), weight * np.maximum(p * (1 - p), 1e-6)
            node, splits = np.zeros(len(y), np.int64), []
            for level in range(self.depth):
                n = 1 << level
                best, feature, cut = np.full(n, 1e-9), np.zeros(n, np.int64), np.full(n, self.bins)
                for f in range(x.shape[1]):
                    at = node * self.bins + np.minimum(binned[:, f], self.bins - 1)
                    gl = np.bincount(at, g, n * self.bins).reshape(n, -1).cumsum(axis=1)
                    hl = np.bincount(at, h, n * self.bins).reshape(n, -1).cumsum(axis=1)
                    gr, hr = gl[:, -1:] - gl, hl[:, -1:] - hl
                    gain = gl**2 / (hl + self.ridge) + gr**2 / (hr + self.ridge) - gl[:, -1:] ** 2 / (hl[:, -1:] + self.ridge)
                    gain[(hl < 1) | (hr < 1)] = 0
                    k = gain.argmax(axis=1)
                    better = gain[np.arange(n), k] > best
                    best[better], feature[better], cut[better] = gain[np.arange(n), k][better], f, k[better]
                values = [edges[f][c] if c < len(edges[f]) else np.inf for f, c in zip(feature, cut)]
                splits.append((feature, np.array(values)))
                node = 2 * node + (x[np.arange(len(y)), feature[node]] > splits[-1][1][node])
            leaves = 1 << self.depth
            value = -self.rate * np.bincount(node, g, leaves) / (np.bincount(node, h, leaves) + self.ridge)
            total += value[node]
            self.trees.append((splits, value))
        return self

    def raw(self, x: np.ndarray) -> np.ndarray:
        total, row = np.full(len(x), self.start), np.arange(len(x))
        for splits, value in self.trees:
            node = np.zeros(len(x), np.int64)
            for feature, cut in splits:
                node = 2 * node + (x[row, feature[node]] > cut[node])
            total += value[node]
        return total


def isotonic(raw: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the non-decreasing least-squares fit: pool adjacent violators, each pool at its mean."""
    pools: list[list[float]] = []
    for k in np.argsort(raw, kind="stable"):
        pools.append([weight[k], weight[k] * y[k], weight[k] * raw[k]])
        while len(pools) > 1 and pools[-2][1] * pools[-1][0] >= pools[-1][1] * pools[-2][0]:
            w, s, r = pools.pop()
            pools[-1] = [pools[-1][0] + w, pools[-1][1] + s, pools[-1][2] + r]
    return np.array([r / w for w, _, r in pools]), np.array([s / w for w, s, _ in pools])


class Scorer:
    """Learned stems, trees and calibration."""

    def __init__(self, learned: Stems | None = None, trees: Trees | None = None, knots=None, constant: float = 0.0):
        self.learned, self.trees, self.knots, self.constant = learned, trees, knots, constant

    def score(self, texts: list[bytes | None]) -> np.ndarray:
        if self.trees is None:
            return np.full(len(texts), self.constant)
        raw = self.trees.raw(matrix(texts, self.learned))
        # The calibrated share, with a thousandth of the plain score so that order is kept within a pool.
        return np.clip(0.999 * np.interp(raw, *self.knots) + 0.001 / (1 + np.exp(-raw)), 0, 1)


def _stems(sample: DataFrame) -> dict[int, Stems]:
    """Stems that mark label 1, learned from rows of half 0, half 1, and both (key 2): at most STEMS each."""

    def count(batches):
        held: dict[str, list[int]] = {}
        for part in slices(batches, "text", SLICE_BYTES):
            for half, y, text in zip(*(part.column(c).to_pylist() for c in ("half", "y", "text"))):
                words = {w.decode("utf-8", "replace") for w in _words(text)[1]}
                for stem in {w[:k] for w in words for k in STEM_LENGTHS if len(w) >= k}:
                    held.setdefault(stem, [0, 0, 0, 0])[2 * half + y] += 1
            if len(held) > 200_000:
                yield packed(held)
                held = {}
        if held:
            yield packed(held)

    def packed(held):
        return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), *(pa.array([v[k] for v in held.values()], pa.int64()) for k in range(4))], ["stem", "n00", "n01", "n10", "n11"])

    counts = arrow_map(sample.select("half", "y", "text"), count, "stem string, n00 long, n01 long, n10 long, n11 long")
    counts = counts.groupBy("stem").agg(*[F.sum(c).alias(c) for c in ("n00", "n01", "n10", "n11")]).where(F.col("n01") + F.col("n11") >= STEM_TEXTS // 2).persist()
    sizes = {(r["half"], r["y"]): r["count"] for r in sample.groupBy("half", "y").count().collect()}
    out = {}
    for key, halves in ((0, (0,)), (1, (1,)), (2, (0, 1))):
        pos, neg = (sum((F.col(f"n{h}{y}") for h in halves), F.lit(0)) for y in (1, 0))
        n_pos, n_neg = (max(sum(sizes.get((h, y), 0) for h in halves), 1) for y in (1, 0))
        odds = F.log((pos + 0.5) / (n_pos + 1)) - F.log((neg + 0.5) / (n_neg + 1))
        enough = STEM_TEXTS if key == 2 else STEM_TEXTS // 2
        top = counts.select("stem", odds.alias("odds"), (odds * F.sqrt(pos)).alias("rank")).where((pos >= enough) & (odds >= STEM_ODDS)).orderBy(F.col("rank").desc(), "stem").limit(10 * STEMS).collect()
        kept: dict[str, float] = {}
        for r in top:
            # A longer stem is kept beside a shorter one only if it says more.
            if len(kept) < STEMS and not any(kept.get(r["stem"][:k], -9.0) >= r["odds"] - 0.5 for k in range(2, len(r["stem"]))):
                kept[r["stem"]] = r["odds"]
        out[key] = Stems(kept)
    counts.unpersist()
    return out


def fit(docs: DataFrame, labels: DataFrame, column: str = "toxic", folds: int = FOLDS, held_out: int = HELD_OUT) -> Scorer:
    known = agreed(labels, column, folds, held_out).join(docs.select(F.col("doc_id").cast("long").alias("doc_id")).distinct(), "doc_id", "left_semi").persist()
    counts = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    if len(counts) < 2:
        known.unpersist()
        return Scorer(constant=float(next(iter(counts), 0)))
    chosen = by_hash(known.where("y = 1"), SAMPLE_POSITIVE).unionByName(by_hash(known.where("y = 0"), SAMPLE_NEGATIVE))
    half = F.pmod(F.floor(F.crc32(F.col("doc_id").cast("string").cast("binary")) / 64), F.lit(2)).cast("int")
    # One row of each id, however often it stands in the documents: that with the least text.
    drawn_rows = with_texts(docs, chosen).groupBy("doc_id", "y").agg(F.min("text").alias("text"))
    sample = written(drawn_rows.withColumn("half", half), "toxicity-sample")
    learned = _stems(sample)

    def measure(batches):
        for part in slices(batches, "text", SLICE_BYTES):
            halves = part.column("half").to_pylist()
            x = np.concatenate([matrix([t], learned[1 - h]) for t, h in zip(part.column("text").to_pylist(), halves)])
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("y"), pa.array(list(x), pa.list_(pa.float64()))], ["doc_id", "y", "x"])

    rows = arrow_map(sample.select("doc_id", "y", "half", "text"), measure, "doc_id long, y int, x array<double>").orderBy("doc_id").collect()
    known.unpersist()
    x, y = np.array([r["x"] for r in rows], float), np.array([r["y"] for r in rows], float)
    drawn = np.array([(y == 0).sum(), (y == 1).sum()])
    weight = np.array([counts[0], counts[1]])[y.astype(int)] / np.maximum(drawn, 1)[y.astype(int)]
    weight /= weight.mean()
    turn = np.arange(len(y)) % 3
    raw = np.zeros(len(y))
    for k in range(3):
        if len(set(y[turn != k])) == 2:
            raw[turn == k] = Trees().fit(x[turn != k], y[turn != k], weight[turn != k]).raw(x[turn == k])
    return Scorer(learned[2], Trees().fit(x, y, weight), isotonic(raw, y, weight))


def score(docs: DataFrame, scorer, folds: int = FOLDS, held_out: int = HELD_OUT, cutoff: float = CUTOFF) -> DataFrame:
    """(doc_id, held_out, score, predicted): one row per document."""

    def run(batches):
        for part in slices(batches, "text", SLICE_BYTES):
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(scorer.score(part.column("text").to_pylist()), pa.float64())], ["doc_id", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    scored = arrow_map(rows, run, "doc_id long, score double")
    return scored.select("doc_id", (fold(F.col("doc_id"), folds) == held_out).alias("held_out"), "score", (F.col("score") >= cutoff).cast("int").alias("predicted"))
