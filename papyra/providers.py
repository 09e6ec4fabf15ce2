"""Model-backed steps behind small protocols, each with a deterministic stand-in that needs no network.

A stand-in makes no claim to the scores of a model. Providers run on executors in Arrow batches, retry with growing
pauses, and report errors per row instead of failing the task.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import time
from collections.abc import Callable, Iterator
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from papyra.shared import ship

MAX_BATCH, DEFAULT_BATCH, TOP_N = 10, 8, 20
_TOKEN = r"[a-z0-9]+|[一-鿿]"


class Embedder(Protocol):
    def embed(self, texts: list[str]) -> list[list[float]]: ...


class Reranker(Protocol):
    def scores(self, query: str, documents: list[str]) -> list[tuple[int, float]]: ...


class Generator(Protocol):
    def answer(self, messages: list[dict]) -> str: ...


class Judge(Protocol):
    def judge(self, prompt: str) -> str: ...


class HashEmbedder:
    """Signed feature hashing of character trigrams, unit length."""

    def __init__(self, dim: int = 256):
        self.dim = dim

    def embed(self, texts: list[str]) -> list[list[float]]:
        if not texts:
            raise ValueError("no texts to embed")
        out = np.zeros((len(texts), self.dim))
        for row, text in zip(out, texts):
            for k in range(max(len(text) - 2, 1)):
                h = int.from_bytes(hashlib.blake2b(text[k : k + 3].encode(), digest_size=8).digest(), "big")
                row[h % self.dim] += 1 if h >> 63 else -1
        return (out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12)).tolist()


class OverlapReranker:
    """Share of the query's characters that the document has."""

    def scores(self, query: str, documents: list[str]) -> list[tuple[int, float]]:
        want = set(query.lower()) - {" "}
        rated = [(k, len(want & set(d.lower())) / max(len(want), 1)) for k, d in enumerate(documents)]
        return sorted(rated, key=lambda x: (-x[1], x[0]))


class ExtractiveGenerator:
    """The line of the passages that has most of the question's tokens, the first of equals, with its citation; the refusal
    without passages."""

    def answer(self, messages: list[dict]) -> str:
        passages, _, question = messages[-1]["content"].rpartition("【问题】")
        want, head, best = set(re.findall(_TOKEN, question.lower())), "", None
        for line in filter(None, passages.split("\n")):
            if line.startswith("[chunk_"):
                head = line.split("]")[0] + "]"
            elif head:
                shared = len(want & set(re.findall(_TOKEN, line.lower())))
                if best is None or shared > best[0]:
                    best = (shared, f"{line} {head}")
        return best[1] if best else "资料中没有相关信息"


class MechanicalJudge:
    """Full marks where the answer's text is part of the prompt, none elsewhere."""

    def judge(self, prompt: str) -> str:
        answer = prompt.rsplit("【系统生成的回答】", 1)[-1].strip().split(" [chunk_")[0]
        mark = float(bool(answer) and prompt.count(answer) > 1)
        return json.dumps({m: mark for m in ("faithfulness", "citation", "answer_accuracy", "rejection")})


def retried(call: Callable, tries: int = 4, pause: Callable[[int], float] = lambda n: 1.5 * (n + 1), final: Callable[[Exception], bool] = lambda e: False, sleep=time.sleep):
    """``call`` with up to ``tries`` attempts; errors for which ``final`` is true end it at once."""
    for n in range(tries):
        try:
            return call()
        except Exception as e:
            if final(e) or n + 1 == tries:
                raise
            sleep(pause(n))


class ProviderError(Exception):
    """A provider's refusal, with the status of its reply."""

    def __init__(self, status: int, message: str = ""):
        super().__init__(f"status {status}: {message}" if message else f"status {status}")
        self.status = status


def is_final(e: Exception) -> bool:
    """Whether trying again is of no use: statuses 400 to 499 but 429. Network errors and 5xx are worth another try. The status is
    looked for where HTTP clients keep it."""
    given = (getattr(e, "status", None), getattr(e, "code", None), getattr(getattr(e, "response", None), "status_code", None))
    status = next((x for x in given if isinstance(x, int)), None)
    return isinstance(status, int) and 400 <= status < 500 and status != 429


def batch_size(asked: int = DEFAULT_BATCH) -> int:
    return min(max(asked, 1), MAX_BATCH)


def embed_table(rows: DataFrame, embedder: Embedder, size: int = DEFAULT_BATCH) -> DataFrame:
    """(id, embedding) of rows (id, text), embedded in batches."""
    size = batch_size(size)

    def run(frames: Iterator[pd.DataFrame]):
        for pdf in frames:
            vectors: list = []
            for k in range(0, len(pdf), size):
                texts = pdf["text"].iloc[k : k + size].fillna("").tolist()
                vectors += retried(lambda texts=texts: embedder.embed(texts))
            yield pd.DataFrame({"id": pdf["id"], "embedding": vectors})

    ship(rows.sparkSession)
    return rows.select("id", "text").mapInPandas(run, f"id {rows.schema['id'].dataType.simpleString()}, embedding array<float>")


def dimension(embedder: Embedder) -> int:
    return len(embedder.embed(["probe"])[0])


def rerank_table(candidates: DataFrame, reranker: Reranker, k: int) -> DataFrame:
    """(qid, id, score, rank) from (qid, question, rank, id, text): the candidates of a query go to the model together, best
    first; of the results the best ``TOP_N`` and then ``k`` are taken, and indexes outside the candidates left out after that."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("rank").reset_index(drop=True)
        found = reranker.scores(pdf["question"].iloc[0], pdf["text"].tolist())
        best = [(i, s) for i, s in sorted(found, key=lambda x: -x[1])[:TOP_N][:k] if 0 <= i < len(pdf)]
        return pd.DataFrame({"qid": pdf["qid"].iloc[0], "id": [pdf["id"][i] for i, _ in best], "score": [float(s) for _, s in best], "rank": range(1, len(best) + 1)})

    s = candidates.schema
    ship(candidates.sparkSession)
    return candidates.groupBy("qid").applyInPandas(run, f"qid {s['qid'].dataType.simpleString()}, id {s['id'].dataType.simpleString()}, score double, rank int")


def generate_table(rows: DataFrame, generator: Generator, pause: Callable[[int], float] = lambda n: 2.0 * 2**n) -> DataFrame:
    """(qid, answer, error) from (qid, messages); a failing call gives its error and an empty answer. Refusals for good aren't
    tried again."""

    def run(frames: Iterator[pd.DataFrame]):
        for pdf in frames:
            out = []
            for qid, given in zip(pdf["qid"], pdf["messages"]):
                try:
                    out.append((qid, retried(lambda given=given: generator.answer([dict(m) for m in given]), pause=pause, final=is_final), None))
                except Exception as e:
                    out.append((qid, "", f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(out, columns=["qid", "answer", "error"])

    ship(rows.sparkSession)
    return rows.select("qid", "messages").mapInPandas(run, f"qid {rows.schema['qid'].dataType.simpleString()}, answer string, error string")


def judge_table(rows: DataFrame, judge: Judge) -> DataFrame:
    """(qid, raw) from (qid, prompt); null where the call fails."""

    def run(frames: Iterator[pd.DataFrame]):
        for pdf in frames:
            out = []
            for prompt in pdf["prompt"]:
                try:
                    out.append(judge.judge(prompt))
                except Exception:
                    out.append(None)
            yield pd.DataFrame({"qid": pdf["qid"], "raw": out})

    ship(rows.sparkSession)
    return rows.select("qid", "prompt").mapInPandas(run, f"qid {rows.schema['qid'].dataType.simpleString()}, raw string")


class LetterEmbedder:
    """How often each of the letters a to z stands in a text."""

    def embed(self, texts: list[str]) -> list[list[float]]:
        if not texts:
            raise ValueError("no texts to embed")
        return [[float(t.count(chr(97 + k))) for k in range(26)] for t in texts]


def load_env(path: str) -> dict[str, str]:
    """KEY=VALUE lines of a file, quotes stripped, comments skipped; what the environment has already stays. Returns what was set."""
    fresh = {}
    with open(path, encoding="utf-8") as f:
        for line in map(str.strip, f):
            key, eq, value = line.partition("=")
            if eq and not line.startswith("#") and key.strip() not in os.environ:
                fresh[key.strip()] = os.environ[key.strip()] = value.strip().strip("\"'")
    return fresh
