import math
import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from weir.functions import text as X
from weir.operators import language, quality
from weir.operators.language import NgramModel, fit_language_model

DOCS = os.environ.get("WEIR_DOCS", "/root/testdata/sf0.01/documents.parquet")


def grams(text, buckets):
    for w in text.lower().split():
        p, s = ([ord(c) for c in x] + [0] * 3 for x in (w[:3], w[::-1][:3]))
        yield (p[0] * 961 + p[1] * 31 + p[2]) % buckets
        yield buckets + (s[0] * 961 + s[1] * 31 + s[2]) % buckets


def plain_fit(rows, buckets):
    counts = {}
    for text, label in rows:
        if text is not None and label is not None:
            counts.setdefault(label, Counter()).update(grams(text, buckets))
    return {k: [math.floor(1000 * math.log((c[b] + 0.5) / (sum(c.values()) + buckets))) for b in range(2 * buckets)] for k, c in counts.items()}


def plain_score(model, text, buckets):
    ids = list(grams(text, buckets))
    s = {k: sum(w[i] for i in ids) for k, w in model.items()}
    best = min(s, key=lambda k: (-s[k], k))
    return (best, 1 / sum(math.exp((v - s[best]) / 1000) for v in s.values())) if ids else ("und_Latn", 0.0)


def test_same_as_plain_counts(spark, tmp_path):
    rows = [("the cat and the dog", "en"), ("der Hund und die Katze", "de"), ("a é 日本 x", "zz"), ("", "en"), (None, "de"), ("nobody knows", None), ("The CAT and the", "en")]
    df = spark.createDataFrame(rows, "text string, lang string")
    model = fit_language_model(df, buckets=64)
    want = plain_fit(rows, 64)
    assert dict(zip(model.labels, model.weights, strict=True)) == want
    model.save(f"{tmp_path}/m.json")
    asked = [(t,) for t in ("the dog", "die Katze", "", " \n", None, "日本", "qqq", "the " * 5000)]
    got = quality.identify_language(spark.createDataFrame(asked, "text string"), ["text"], NgramModel.load(f"{tmp_path}/m.json")).collect()
    for r in got:
        lid, prob = (None, None) if r.text is None else plain_score(want, r.text, 64)
        assert r.text_lid == lid and (prob is None or abs(r.text_lid_prob - prob) < 1e-9)


def test_better_than_the_word_lists_on_held_out_rows(spark):
    if not os.path.exists(DOCS):
        pytest.skip("no documents")
    labels = F.create_map(*[F.lit(x) for kv in {"en": "eng_Latn", "de": "deu_Latn", "fr": "fra_Latn", "es": "spa_Latn"}.items() for x in kv])
    df = spark.read.parquet(DOCS).select("doc_id", "text", F.element_at(labels, F.col("lang")).alias("lang")).where(F.col("text").isNotNull())
    held = df.where(F.pmod("doc_id", F.lit(5)) == 0)
    model = fit_language_model(df.where(F.pmod("doc_id", F.lit(5)) != 0))
    right = [quality.identify_language(held, ["text"], m).agg(F.avg((F.col("text_lid") == F.col("lang")).cast("double"))).first()[0] for m in (model, quality.STAND_IN)]
    assert right[0] > 0.97 and right[0] > right[1]


def test_sample_is_bounded_and_keeps_rare_labels(spark):
    df = spark.range(4000).select(F.concat(F.lit("word"), F.col("id").cast("string")).alias("text"), F.when(F.col("id") % 400 == 0, "rare").otherwise("hot").alias("lang"))
    model = fit_language_model(df, max_rows=400, buckets=16)
    assert model.labels == ["hot", "rare"]
    seen = {}
    assert model.weights == fit_language_model(df.repartition(7), max_rows=400, buckets=16).weights
    for label, w in zip(model.labels, model.weights, strict=True):
        seen[label] = max(w)
    assert all(v > -2000 for v in seen.values())
    with pytest.raises(ValueError):
        fit_language_model(df.where("id < 0"))


def test_all_rows_count_however_many(spark):
    """More rows than the 100,000 that were once the most; a label whose only row has no words stays."""
    n = 120_000
    said = F.when(F.col("id") == 7, "").otherwise(F.concat(F.lit("w"), F.col("id").cast("string")))
    df = spark.range(n).select(said.alias("text"), F.when(F.col("id") == 7, "none").when(F.col("id") % 3 == 0, "a").otherwise("b").alias("lang"))
    model = fit_language_model(df, buckets=64)
    want = plain_fit([("", "none") if i == 7 else (f"w{i}", "b" if i % 3 else "a") for i in range(n)], 64)
    assert model.labels == ["a", "b", "none"] and dict(zip(model.labels, model.weights, strict=True)) == want


def test_stop_words(spark):
    rows = spark.createDataFrame([("De kat, en het huis.",), ("the end of it",), ("",), (None,), ("xyz",)], "text string")
    got = quality.identify_language(rows, ["text"]).collect()
    assert [(r.text_lid, r.text_lid_prob) for r in got] == [("nld_Latn", 0.75), ("eng_Latn", 1.0), ("und_Latn", 0.0), (None, None), ("und_Latn", 0.0)]
    plan = quality.identify_language(rows, ["text"])._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    by_function = quality.identify_language(rows, ["text"], lambda: lambda t: ("__label__x", float(len(t)))).first()
    assert (by_function.text_lid, by_function.text_lid_prob) == ("x", 20.0)


def test_keys_are_in_whatever_the_pattern_fits(spark):
    texts = ["als een AI-taalmodel", "AſſISTENT ben", "ChatGPT", "GPT 3", "it ſeems like there was a typo", "mİjn excuses", "SPIJT ME", "Knowledge", "gewoon", "cutoff İn 2023", "assıstant"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    p, k = quality.phrase_pattern(), quality.phrase_keys()
    got = df.select(F.col("t").rlike(p).alias("a"), quality.has_phrase(F.col("t"), p, k).alias("b")).collect()
    assert [r.a for r in got] == [r.b for r in got] and sum(r.a for r in got) >= 6
    assert language.NONE == "und_Latn"


def test_listed_phrases_are_what_the_pattern_fits_and_fold_a_text_once(spark):
    texts = ["als een AI-taalmodel", "ALS Taalmodel", "AſſISTENT ben", "ben een assistent", "de assistent van", "ChatGPT", "GPT 3", "it ſeems like there was a typo", "mİjn excuses", "SPIJT ME", "\u212annisstop", "\u212aennisstop in 2023", "Knowledge", "gewoon", "cutoff İn 2023", "assıstant", "taalmodel  ben", "virtuele assistent ben", "als een  taalmodel", "", "Tekstgebaseerde asssistent ben"]
    df = spark.createDataFrame([(t,) for t in texts] + [(None,)], "t string")
    got = df.select("t", F.col("t").rlike(quality.phrase_pattern()).alias("a"), quality.has_listed_phrase(F.col("t")).alias("b")).collect()
    assert [(r.t, r.a) for r in got] == [(r.t, r.b) for r in got] and 10 <= sum(r.a or False for r in got) < len(texts)
    names, lists = ["loser"], [["the", "Open.AI"]]
    own = df.select(F.col("t").rlike(quality.phrase_pattern(names, lists)).alias("a"), quality.has_listed_phrase(F.col("t"), names, lists).alias("b")).collect()
    assert [r.a for r in own] == [r.b for r in own]
    with pytest.raises(ValueError):
        quality.has_listed_phrase(F.col("t"), ["modèle"])
    plan = quality.quality_filter(df, ["t"], target=None)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("lower(") == 1 and "translate(" not in plan


def test_more_words(spark):
    texts = ["", " \n", "a", "a b", "a b c", " a\tb\u3000c ", "a b c d", "\na\u2003b c  d e", " " * 9000 + "a b c", "a b c" + " " * 9000]
    got = spark.createDataFrame([(t,) for t in [*texts, None]], "t string").select("t", X.more_words(F.col("t"), 3).alias("m"), X.token_count(F.col("t")).alias("n")).collect()
    assert [r.m for r in got[:-1]] == [len(t.split()) > 3 for t in texts] and got[-1].m is None and got[-1].n is None
    assert [r.n for r in got[:-1]] == [len(t.split()) for t in texts]


def test_scores_are_those_of_single_words(spark):
    """Texts whose words are short, long and of all scripts, in one batch and in many; a word never reaches into its neighbour."""
    import numpy as np
    import pyarrow as pa

    rng = np.random.default_rng(3)
    weights = rng.integers(-9000, 0, (3, 128)).tolist()
    model = NgramModel(["a", "b", "c"], weights, 64)
    letters = list("abcdefgé日\U0001f600ß")
    texts = ["", None, "a", " ", "　ab\tc ", *[" ".join("".join(rng.choice(letters, rng.integers(1, 7))) for _ in range(rng.integers(1, 40))) for _ in range(200)]]
    df = spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1)
    want = [(None, None) if t is None else plain_score(dict(zip(model.labels, weights, strict=True)), t, 64) for t in texts]
    for r, (lid, prob) in zip(quality.identify_language(df, ["text"], model).collect(), want, strict=True):
        assert r.text_lid == lid and (prob is None or abs(r.text_lid_prob - prob) < 1e-9)
    sums, n = language.score_words(pa.array(["ab c", None, "", "c"]), np.array(weights, float))
    assert n.tolist() == [4, 0, 0, 2] and (sums[:, 1:3] == 0).all()
    assert "aggregate(" not in quality.identify_language(df, ["text"], model)._jdf.queryExecution().optimizedPlan().toString()
