import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from docketframe.llm import language_id
from tests.llm.odd import SCHEMA, empty_documents, odd_documents, odd_rows, with_clashes

PARTS = {"aa": "ka lo mi ne pu ra".split(), "bb": "sch ung keit ver ein ß".split(), "cc": "ción que ñ os ar ll".split(), "dd": "æt ør ård sk hv ej".split()}


def words(lang, seed, n):
    rng = random.Random(f"{lang}{seed}")
    return " ".join("".join(rng.choices(PARTS[lang], k=rng.randint(1, 4))) for _ in range(n))


def made_rows(each=80):
    return [(i * 4 + k, words(lang, i, 3 + i), lang, "a", 0) for i in range(each) for k, lang in enumerate(PARTS)]


@pytest.mark.parametrize("languages", [0, 1, 2, 3, 5, 40])
def test_codewords_are_apart(languages):
    code = language_id.codewords(languages)
    assert len(code) == languages and set(np.unique(code)) <= {-1.0, 1.0}
    for i in range(languages):
        for j in range(i):
            assert (code[i] != code[j]).sum() >= max(1, code.shape[1] // 8)


def test_features_of_chunks_are_those_of_the_whole(monkeypatch):
    text = words("bb", 1, 3000) + " 12 !!"
    whole = language_id.features(text)
    monkeypatch.setattr(language_id, "_CHUNK", 997)
    assert np.allclose(language_id.features(text), whole, atol=1e-3)
    assert language_id.features("12 !! \n") is None and language_id.features("") is None
    assert np.isclose((language_id.features("é") ** 2).sum(), 1, atol=1e-3)


def test_held_out_languages_are_found(spark):
    rows = made_rows()
    truth = {row[0]: row[2] for row in rows}
    hidden = [(d, t, None if zlib.crc32(str(d).encode()) % 4 == 2 else lang, s, n) for d, t, lang, s, n in rows]
    found = language_id.language_report(with_clashes(spark.createDataFrame(hidden, SCHEMA))).collect()
    assert len(found) == len(rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in found)
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in found if r.held_out]) > 0.95
    assert all(0 <= r.score <= 1 for r in found)


def test_labels_of_held_out_rows_and_other_columns_are_not_read(spark):
    rows = made_rows(30)
    first = language_id.language_report(spark.createDataFrame(rows, SCHEMA)).collect()
    changed = [(d, t, "zz" if zlib.crc32(str(d).encode()) % 4 == 2 else lang, f"s{d}", d) for d, t, lang, s, n in rows]
    again = language_id.language_report(spark.createDataFrame(changed, SCHEMA)).collect()
    assert sorted(map(tuple, first)) == sorted(map(tuple, again))


def test_odd_documents(spark):
    found = language_id.language_report(with_clashes(odd_documents(spark))).collect()
    assert Counter(r.doc_id for r in found) == Counter(row[0] for row in odd_rows())
    unknown = Counter(row[0] for row in odd_rows() if not any(c.isalpha() for c in row[1] or ""))
    assert Counter(r.doc_id for r in found if r.lang_pred == "und") == unknown
    assert all(r.score == 0 for r in found if r.lang_pred == "und")
    kept = language_id.known_language(with_clashes(odd_documents(spark)))
    assert kept.columns == with_clashes(odd_documents(spark)).columns
    assert {r.lang_pred for r in kept.select("lang_pred").collect()} == {"clash"}
    assert not any(r.text is None for r in kept.collect())


def test_no_language_or_one_or_no_rows(spark):
    assert language_id.language_report(empty_documents(spark)).collect() == []
    unlabelled = odd_documents(spark).withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in language_id.language_report(unlabelled).collect()} == {"und"}
    single = odd_documents(spark).withColumn("lang", F.lit("xx"))
    assert {(r.lang_pred, r.score) for r in language_id.language_report(single).collect()} == {("xx", 1.0), ("und", 0.0)}


@pytest.mark.parametrize("text, known", [("\u00b2 \u00bd \u2460 12", False), ("\u0301\u20ac", False), ("\u00aa", True), ("\u6f22", True), ("1x", True)])
def test_letters_are_what_unicode_calls_letters(text, known):
    assert (language_id.features(text) is not None) == known


def test_loss_weighted_decoding_against_a_plain_count():
    rng = np.random.default_rng(3)
    for _ in range(20):
        n = int(rng.integers(2, 9))
        names = [f"l{i}" for i in range(n)]
        code = language_id.codewords(n)
        weights = rng.random(code.shape) + 0.1
        model = language_id.Model(names, code, weights / weights.sum(axis=1, keepdims=True), rng.normal(size=(language_id.FEATURES, code.shape[1])).astype(np.float32), rng.normal(size=code.shape[1]).astype(np.float32))
        text = words("aa", int(rng.integers(1000)), 12)
        vector = language_id.features(text)
        losses = []
        for i in range(n):
            total = 0.0
            for j in range(code.shape[1]):
                answer = float(sum(vector[k] * model.weights[k, j] for k in np.flatnonzero(vector)) + model.bias[j])
                total += float(model.bit_weights[i, j]) * float(np.log1p(np.exp(-code[i, j] * answer)))
            losses.append(total)
        found, score, ambiguous = model.predict(text)
        ranked = sorted(range(n), key=lambda i: losses[i])
        assert found == names[ranked[0]] and 1 / n <= score <= 1
        assert ambiguous == (losses[ranked[1]] - losses[ranked[0]] < language_id.MARGIN)


def test_columns_named_as_what_is_predicted_are_kept(spark):
    documents = spark.createDataFrame(made_rows(20), SCHEMA).selectExpr("*", "'a' AS lang_pred", "'b' AS __lang_pred", "'c' AS own_score", "'d' AS Score")
    kept = language_id.known_language(documents)
    assert kept.columns == documents.columns
    assert {(r.lang_pred, r["__lang_pred"], r.own_score, r.Score) for r in kept.collect()} == {("a", "b", "c", "d")}
