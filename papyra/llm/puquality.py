"""Quality scores by positive-unlabelled learning: the non-negative unbiased risk estimator.

Trusted positives are rows labelled 1 outside the held-out fold; the unlabelled set is a sample of the documents outside
that fold, without their labels. Labels 0 are not used. The class prior is estimated from these two sets: a network told
to part one half of both gives scores, and of the thresholds on them that is taken at which the other half's unlabelled
share above it, divided by the positive share above it, is least once the deviation of both shares is added; the quotient
there is the prior. A small network over dense features of the whole text then minimises
prior * R+(positives) + max(0, R-(unlabelled) - prior * R-(positives)) for the logistic loss; where the second
term falls below zero in a step, its gradient is turned round. Samples are bounded by ``SAMPLE_POSITIVE`` and
``SAMPLE_UNLABELLED`` documents, those with the least md5 of the id; one row of each id is collected.

Nulls and empties: a null or empty text has zero features and gets a score like any other. Null labels and
ids with both labels aren't learned from; rows of a null doc_id are scored, with held_out false. Of rows that repeat an
id that with the least features is learned from. Without positives every score is 0. Extra columns are ignored, repeated
rows are repeated in the result, an empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from papyra.llm.common import arrow_map, fold, keep_rows, slices
from papyra.llm.labelled import agreed, by_hash, with_texts
from papyra.shared import written

FOLDS, HELD_OUT, CUTOFF = 5, 0, 0.3
SAMPLE_POSITIVE, SAMPLE_UNLABELLED, SLICE_BYTES = 12_000, 16_000, 4 << 20
HIDDEN, STEPS, BATCH, RATE, SEED = 24, 1500, 1024, 0.01, 11
_LETTERS = np.array([chr(b).isalpha() and b < 128 for b in range(256)])
_SYMBOLS = [ord(c) for c in "#*$%&|<>^~@=_+\\{}[]"]
NAMES = ["words", "mean", "spread", "upper", "digits", "symbols", "exclaims", "questions", "stops", "commas", "bars", "twins", "distinct", "top", "run", "lines", "dup_lines", "single", "long", "high", "pairs", "ends"]


def features(text: bytes) -> list[float]:
    """The figures of ``NAMES`` for one text."""
    words = text.split()
    if not words:
        return [0.0] * len(NAMES)
    n, size = len(words), len(text)
    count = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    alpha = max(int(count[_LETTERS].sum()), 1)
    sizes = np.fromiter(map(len, words), np.int64, n)
    bag = Counter(words)
    same = np.fromiter(map(bytes.__eq__, words[1:], words[:-1]), bool, n - 1)
    edge = np.flatnonzero(np.diff(np.concatenate([[0], same.astype(np.int8), [0]])))
    run = int((edge[1::2] - edge[::2]).max()) + 1 if len(edge) else 1
    lines = [x for x in text.split(b"\n") if x.strip()]
    pairs = len(set(zip(words, words[1:]))) / max(n - 1, 1)
    return [
        np.log1p(n), sizes.mean(), sizes.std(), int(count[65:91].sum()) / alpha, int(count[48:58].sum()) / size, int(count[_SYMBOLS].sum()) / n,
        int(count[33]) / n, int(count[63]) / n, int(count[46]) / n, int(count[44]) / n, int(count[124]) / n, int(same.sum()) / n, len(bag) / n, bag.most_common(1)[0][1] / n,
        np.log1p(run), len(lines) / n, 1 - len(set(lines)) / max(len(lines), 1), int((sizes == 1).sum()) / n, int((sizes > 12).sum()) / n, int(count[128:].sum()) / size, pairs,
        float(text.rstrip()[-1:] in (b".", b"!", b"?")),
    ]


def matrix(texts: list[bytes | None]) -> np.ndarray:
    return np.array([features(t or b"") for t in texts], float).reshape(-1, len(NAMES))


class Network:
    """One hidden layer over standardised features, and the square of each."""

    def __init__(self, x: np.ndarray, seed: int = SEED):
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-6
        rng = np.random.default_rng(seed)
        d = 2 * x.shape[1]
        self.w = [rng.normal(0, d**-0.5, (d, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(1)]

    def prepared(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -6, 6)
        return np.concatenate([z, z * z / 6], axis=1)

    def logit(self, z: np.ndarray) -> np.ndarray:
        return np.tanh(z @ self.w[0] + self.w[1]) @ self.w[2] + self.w[3]

    def gradients(self, z: np.ndarray, slope: np.ndarray) -> list[np.ndarray]:
        """Gradients of sum(slope * logit)."""
        h = np.tanh(z @ self.w[0] + self.w[1])
        back = slope[:, None] * self.w[2] * (1 - h * h)
        return [z.T @ back, back.sum(axis=0), h.T @ slope, slope.sum(keepdims=True)]

    def plain(self, p: np.ndarray, u: np.ndarray) -> list[np.ndarray]:
        """Gradients of the mean logistic losses of positives as 1 and unlabelled as 0."""
        sp, su = (1 / (1 + np.exp(-self.logit(a))) for a in (p, u))
        return [a + b for a, b in zip(self.gradients(p, (sp - 1) / len(p)), self.gradients(u, su / len(u)))]

    def risk(self, p: np.ndarray, u: np.ndarray, prior: float) -> tuple[float, float, list[np.ndarray]]:
        """The positive part of the risk, the negative part before it is cut at zero, and the gradients of a step."""
        gp, gu = self.logit(p), self.logit(u)
        sp, su = 1 / (1 + np.exp(-gp)), 1 / (1 + np.exp(-gu))
        positive = prior * np.logaddexp(0, -gp).mean()
        negative = np.logaddexp(0, gu).mean() - prior * np.logaddexp(0, gp).mean()
        part = [a - b for a, b in zip(self.gradients(u, su / len(u)), self.gradients(p, prior * sp / len(p)))]
        if negative < 0:
            return positive, negative, [-g for g in part]
        return positive, negative, [a + b for a, b in zip(part, self.gradients(p, prior * (sp - 1) / len(p)))]

    def descend(self, positive: np.ndarray, unlabelled: np.ndarray, gradients, steps: int = STEPS, seed: int = SEED) -> Network:
        rng = np.random.default_rng(seed)
        p_all, u_all = self.prepared(positive), self.prepared(unlabelled)
        first, second = [np.zeros_like(w) for w in self.w], [np.zeros_like(w) for w in self.w]
        for step in range(1, steps + 1):
            grads = gradients(*(a[rng.integers(0, len(a), BATCH)] for a in (p_all, u_all)))
            rate = RATE * (1 - 0.9 * step / steps)
            for k, g in enumerate(grads):
                g = g + 1e-3 * self.w[k] * (k in (0, 2))
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                self.w[k] = self.w[k] - rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
        return self

    def fit(self, positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> Network:
        return self.descend(positive, unlabelled, lambda p, u: self.risk(p, u, prior)[2])


def least_quotient(positive: np.ndarray, unlabelled: np.ndarray, delta: float = 0.1) -> float:
    """The share of positives among unlabelled scores: see above. Between 0 and 1."""
    cuts = np.unique(np.concatenate([positive, unlabelled]))
    share = lambda x: 1 - np.searchsorted(np.sort(x), cuts, "left") / len(x)
    above_p, above_u = share(positive), share(unlabelled)
    margin = sum(np.sqrt(np.log(4 / delta) / (2 * len(x))) for x in (positive, unlabelled))
    some = above_p > 0
    quotient = above_u[some] / above_p[some]
    return float(min(1.0, quotient[np.argmin(quotient + margin / above_p[some])]))


def estimated_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """The class prior, each half scored by a network that has seen the other."""
    halves = [(np.arange(len(x)) % 2 == 0) for x in (positive, unlabelled)]
    found = []
    for turn in (True, False):
        (p, q), (u, v) = ((x[h == turn], x[h != turn]) for x, h in zip((positive, unlabelled), halves))
        if len(p) and len(q) and len(u) and len(v):
            network = Network(np.concatenate([p, u]))
            network.descend(p, u, network.plain, STEPS // 3)
            found.append(least_quotient(*(network.logit(network.prepared(x)) for x in (q, v))))
    return float(np.mean(found)) if found else 1.0


class Scorer:
    def __init__(self, network: Network | None, prior: float):
        self.network, self.prior = network, prior

    def score(self, texts: list[bytes | None]) -> np.ndarray:
        if self.network is None:
            return np.full(len(texts), self.prior)
        return 1 / (1 + np.exp(-np.clip(self.network.logit(self.network.prepared(matrix(texts))), -40, 40)))


def fit(docs: DataFrame, labels: DataFrame, column: str = "quality", folds: int = FOLDS, held_out: int = HELD_OUT) -> Scorer:
    known = agreed(labels, column, folds, held_out).where("y = 1").select("doc_id")
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id is not null").distinct()
    positive = by_hash(known.join(ids, "doc_id", "left_semi"), SAMPLE_POSITIVE)
    unlabelled = by_hash(ids.where(fold(F.col("doc_id"), folds) != held_out), SAMPLE_UNLABELLED)
    roles = positive.select("doc_id", F.lit(1).alias("role")).unionByName(unlabelled.select("doc_id", F.lit(2).alias("role")))
    chosen = written(roles.groupBy("doc_id").agg(F.sum("role").alias("roles")), "pu-sample")

    def measure(batches):
        for part in slices(batches, "text", SLICE_BYTES):
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("roles"), pa.array(list(matrix(part.column("text").to_pylist())), pa.list_(pa.float64()))], ["doc_id", "roles", "x"])

    # One pass over the documents for both samples; one row of each id goes to the driver.
    measured = arrow_map(with_texts(docs, chosen).select("doc_id", "roles", "text"), measure, "doc_id long, roles long, x array<double>")
    rows = measured.groupBy("doc_id").agg(F.min("roles").alias("roles"), F.min("x").alias("x")).orderBy("doc_id").collect()
    of = lambda role: np.array([r["x"] for r in rows if r["roles"] & role], float).reshape(-1, len(NAMES))
    p, u = of(1), of(2)
    if not len(p) or not len(u):
        return Scorer(None, 0.0)
    prior = estimated_prior(p, u)
    network = Network(np.concatenate([p, u]))
    return Scorer(network.fit(p, u, min(max(prior, 0.01), 0.99)), prior)


def keep_good(docs: DataFrame, scorer: Scorer, cutoff: float = CUTOFF) -> DataFrame:
    """The rows of ``docs`` that are predicted 1, with all their columns."""
    return keep_rows(docs, lambda texts: (scorer.score(texts) >= cutoff).tolist(), SLICE_BYTES)
