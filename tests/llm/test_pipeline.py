import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from papyra.llm import decontam, mixing, puquality
from test_dedup import brute_removed, check_kept

EXTRA = ("n_words", "kept_text", "root", "row", "id", "text_hash", "fp", "place", "_id", "_n", "a.b")


def sentence(rng, n):
    return " ".join("".join(rng.choice("abcdefghijklm") for _ in range(rng.randint(2, 8))) for _ in range(n))


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Documents with bad ones, copies, near copies, shared passages, benchmark items, nulls, empties, repeats and clashing columns."""
    rng = random.Random(21)
    items = [sentence(rng, rng.randint(9, 20)) for _ in range(6)] + [None, "", "ab"]
    passage = sentence(rng, 70)
    texts = []
    for i in range(160):
        t = sentence(rng, rng.randint(30, 160)) + "."
        if i % 9 == 0:
            t = "BUY NOW!!! $$$ " * 40
        if i % 13 == 0:
            t = f"{sentence(rng, 30)} {passage} {sentence(rng, 30)}."
        if i % 17 == 0:
            t += f" {items[i % 6]} end."
        texts.append(t)
    for i in range(20):
        words = texts[i * 3 + 1].split()
        words[len(words) // 2] = "changed"
        texts.append(texts[i * 3 + 1] if i % 2 else " ".join(words))
    texts += [None, "", " \n ", sentence(rng, 30_000) + "."]
    rows = [(i, t, ("en", "de", None)[i % 3], (None, "web", "books", "news")[i % 4], None if t is None else len(t)) for i, t in enumerate(texts)]
    rows += [rows[1], rows[1], (None, texts[5], "en", "web", 5), (None, None, None, None, None), (2, texts[8], "en", "web", 9)]
    path = tmp_path_factory.mktemp("tables")
    extra = ", ".join(f"`{c}` string" for c in EXTRA)
    schema = f"doc_id long, text string, lang string, source string, n_chars long, {extra}"
    spark.createDataFrame([(*r, *(f"{c} of {k}" for c in EXTRA)) for k, r in enumerate(rows)], schema).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    spark.createDataFrame([(i, int(i % 9 != 0), 0) for i in range(160)] + [(None, 1, 0), (3, None, None)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return str(path)


def tuples(df):
    return [tuple(r) for r in df.collect()]


def test_stages_against_brute_force(spark, folder):
    given = spark.read.parquet(f"{folder}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "simhash_near_dedup", "substring_dedup", "benchmark_decontamination", "mixing"]
    of = lambda df: df.select("doc_id", "text", *[f"`{c}`" for c in df.columns if c not in ("doc_id", "text")])

    good = stages["quality_classifier"](spark, given, folder).cache()
    scorer = puquality.fit(given, spark.read.parquet(f"{folder}/labels.parquet"))
    assert Counter(tuples(good)) == Counter(r for r in tuples(given) if scorer.score([r[1].encode() if r[1] is not None else None])[0] >= 0.3)
    assert good.schema == given.schema and not any("BUY" in (r["text"] or "") for r in good.collect()) and good.count() > 100

    # The later stages see all rows, bad ones, nulls and empties included.
    one = stages["simhash_near_dedup"](spark, given, folder).cache()
    check_kept(given, tuples(given), one)
    assert one.schema == given.schema and one.count() < given.count()

    cut = stages["substring_dedup"](spark, given, folder)
    words, kept = brute_removed(tuples(given), 50)
    want = Counter()
    for r, w, k in zip(tuples(given), words, kept):
        text = r[1] if len(w) == len(k) else b" ".join(k).decode()
        want[(r[0], text, *r[2:4], r[4] if len(w) == len(k) else len(text), *r[5:])] += 1
    assert Counter(tuples(cut)) == want and cut.dtypes == given.dtypes and any(len(w) != len(k) for w, k in zip(words, kept))

    clean = stages["benchmark_decontamination"](spark, given, folder)
    items = [r["text"] for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    plain = lambda t: decontam.normalise((t or "").encode()).decode()
    dirty = lambda t: any(plain(x) and (f" {plain(x)} " in f" {plain(t)} " if len(plain(x)) < 6 else plain(x) in plain(t)) for x in items)
    assert Counter(tuples(clean)) == Counter(r for r in tuples(given) if not dirty(r[1])) and clean.count() < given.count()

    mixed = stages["mixing"](spark, given, folder).collect()
    assert Counter(r["doc_id"] for r in mixed) == Counter(r[0] for r in tuples(given)) and all(r["taken"] <= 2 * r["size"] for r in mixed)
    assert len(of(given).columns) == len(given.columns)


def test_the_whole_run(spark, folder):
    rows = corpus_pipeline.run(spark, folder).collect()
    again = corpus_pipeline.run(spark, folder).collect()
    assert Counter(rows) == Counter(again) and 50 < len(rows) < 165
    sizes = sum(r["size"] for r in rows)
    assert abs(sum(r["taken"] for r in rows) - mixing.SHARE * sizes) < 0.2 * sizes


def test_empty_tables(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        assert out.count() == 0 and (name == "mixing" or out.columns == docs.columns)


def test_tables_without_rows_to_learn_from(spark, folder, tmp_path):
    spark.read.parquet(f"{folder}/labels.parquet").limit(0).write.parquet(f"{tmp_path}/labels.parquet")
    spark.read.parquet(f"{folder}/benchmark.parquet").limit(0).write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert stages["quality_classifier"](spark, docs, str(tmp_path)).count() == 0  # nothing says what is good
    assert stages["benchmark_decontamination"](spark, docs, str(tmp_path)).count() == docs.count()
    assert docs.select(F.count("*")).first()[0] == docs.count()
