"""What must not move a prediction doesn't; decoding against loops."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import languages, quality
from corpusloom.llm.linear_features import remainder

SMALL = "/root/testdata/sf0.01"


def test_decoding_equals_loops():
    draw = np.random.default_rng(4)
    for n in (2, 3, 5, 7):
        code = languages.codewords(n).astype(np.float32)
        trust = draw.random(code.shape[1]).astype(np.float32)
        model = languages.Model([f"l{k}" for k in range(n)], code, draw.normal(size=(code.shape[1], 12)).astype(np.float32), draw.normal(size=code.shape[1]).astype(np.float32), trust / trust.sum())
        x = draw.normal(size=(20, 12)).astype(np.float32)
        best, score, gap = languages.decode(model, x)
        for row in range(20):
            losses = []
            for k in range(n):
                margins = [sum(float(w) * float(v) for w, v in zip(model.weights[b], x[row])) + float(model.bias[b]) for b in range(code.shape[1])]
                losses.append(sum(float(t) * math.log1p(math.exp(-float(code[k, b]) * m)) for b, (m, t) in enumerate(zip(margins, model.trust))))
            order = sorted(losses)
            assert best[row] == losses.index(order[0])
            assert gap[row] == pytest.approx(order[1] - order[0], abs=1e-4)
            assert score[row] == pytest.approx(1 / sum(math.exp(-(v - order[0]) * code.shape[1]) for v in losses), rel=1e-3)


def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet").cache()


def by_text(found, docs, *columns):
    rows = found.join(docs.select("doc_id", "text"), "doc_id").select("text", *columns).distinct().collect()
    return {(r["text"], *(r[c] for c in columns)) for r in rows}


def test_held_out_rows_do_not_move_languages(spark):
    docs = documents(spark)
    model = languages.train(docs)
    out = remainder(F.col("doc_id"), 3) == 1
    other = docs.withColumns({"text": F.when(out, "zzz qqq xxx").otherwise(F.col("text")), "lang": F.when(out, "zz").otherwise(F.col("lang")), "source": F.lit("s")})
    again = languages.train(other)
    assert again.languages == model.languages and np.array_equal(again.weights, model.weights) and np.array_equal(again.code, model.code) and np.array_equal(again.trust, model.trust)
    moved = docs.withColumns({"lang": F.lit("en"), "source": F.reverse("source"), "doc_id": F.col("doc_id") + 10**6})
    assert by_text(languages.identify(docs, model), docs, "lang_pred", "score") == by_text(languages.identify(moved, model), moved, "lang_pred", "score")


def test_held_out_rows_do_not_move_quality(spark):
    docs, labels = documents(spark), spark.read.parquet(f"{SMALL}/labels.parquet")
    machine = quality.train(docs, labels)
    out = remainder(F.col("doc_id"), 5) == 0
    again = quality.train(docs.withColumn("text", F.when(out, "zzz qqq").otherwise(F.col("text"))).withColumns({"lang": F.lit("x"), "source": F.lit("y")}), labels.withColumn("quality", F.when(out, 1 - F.col("quality")).otherwise(F.col("quality"))))
    assert np.array_equal(machine.linear, again.linear) and np.array_equal(machine.factors, again.factors) and machine.bias == again.bias
    moved = docs.withColumns({"lang": F.lit("en"), "source": F.reverse("source"), "doc_id": F.col("doc_id") + 10**6})
    assert by_text(quality.quality(docs, machine), docs, "score", "predicted") == by_text(quality.quality(moved, machine), moved, "score", "predicted")
