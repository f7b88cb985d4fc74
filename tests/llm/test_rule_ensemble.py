import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from docketframe.llm import rule_ensemble as rules
from docketframe.llm.queries import op13_quality_classifier
from tests.llm.odd import SCHEMA, empty_documents, odd_documents, odd_rows, prose, with_clashes

LABELS = "doc_id long, quality int, toxic int"
SF = "/root/testdata/sf0.1"


def held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 4 == 2


def of(text):
    return dict(zip(rules.STATISTICS, rules.statistics(text, rules._Numbers()), strict=True))


def test_statistics_of_small_texts():
    assert set(of(None).values()) == set(of("").values()) == set(of(" \n\t").values()) == {0.0}
    found = of("Aa bb bb!! | 12\n\n Aa bb $x.\n Aa bb $x.")
    assert found["words"] == 11 and found["lines"] == 3 and found["longest_word"] == 4
    assert found["repeated_lines"] == pytest.approx(1 / 3) and found["ended_lines"] == pytest.approx(2 / 3)
    assert found["shouts"] == pytest.approx(2 / 11) and found["bare_words"] == pytest.approx(1 / 11)
    assert found["top_word"] == pytest.approx(3 / 11) and found["new_words"] == pytest.approx(6 / 11)
    assert found["stutter"] == 0 and of("a a a b")["stutter"] == 0.5
    assert found["digits"] == pytest.approx(2 / 25) and found["symbols"] == pytest.approx(3 / 25)
    assert found["repeats"] == pytest.approx(3 / 11)
    assert of("ab\n" * 50)["density"] < 0.3 and of("aaaa")["entropy"] == 0 and of("abcd")["entropy"] == pytest.approx(2)


def planted(n=4000, seed=1):
    """Label 0 where a conjunction of two statistics holds, with one label in fifty turned."""
    rng = np.random.default_rng(seed)
    table = rng.random((n, len(rules.STATISTICS)))
    label = 1 - ((table[:, 3] > 0.6) & (table[:, 10] <= 0.5)).astype(int)
    turned = rng.random(n) < 0.02
    return table, np.where(turned, 1 - label, label)


def test_a_planted_conjunction_is_found_and_few_rules_stay():
    table, label = planted()
    ensemble = rules.fit(table, label)
    heaviest = ensemble.rules[int(np.argmax(np.abs(ensemble.weights)))]
    assert {at for at, _, _ in heaviest.bounds} <= {3, 10}
    assert len(ensemble.rules) < len(rules.extract(table, label)) / 2
    fresh, wanted = planted(seed=2)
    assert ((ensemble.scores(fresh) >= 0.7) == wanted).mean() > 0.95


def test_rules_are_paths_of_the_trees():
    table, label = planted(600)
    for rule in rules.extract(table, label):
        assert 1 <= len(rule.bounds) <= rules.DEPTH
        assert rules.LEAST_ROWS <= rule.holds(table).sum() <= len(table) - rules.LEAST_ROWS
        assert all(low < high for _, low, high in rule.bounds)


def test_lasso_meets_its_optimality_conditions(monkeypatch):
    monkeypatch.setattr(rules, "STEPS", 3000)
    rng = np.random.default_rng(5)
    held_by = (rng.random((300, 12)) < 0.4).astype(float)
    label = (rng.random(300) < 0.3 + 0.5 * held_by[:, 0]).astype(float)
    penalty = 0.02
    weights, bias = rules.lasso(held_by, label, penalty, np.zeros(12), 0.0, 1 / rules.steepest(held_by))
    slope = held_by.T @ (1 / (1 + np.exp(-(held_by @ weights + bias))) - label) / 300
    assert np.allclose(slope[weights != 0], -penalty * np.sign(weights[weights != 0]), atol=1e-5)
    assert (np.abs(slope[weights == 0]) <= penalty + 1e-5).all() and 0 < (weights == 0).sum() < 12


def test_columns_score_as_the_rules_do(spark):
    table, label = planted(800)
    ensemble = rules.fit(table, label)
    frame = spark.createDataFrame([(i, *map(float, row)) for i, row in enumerate(table)], ["doc_id", *rules.STATISTICS])
    found = frame.select("doc_id", ensemble.score().alias("score"), ensemble.reasons().alias("reasons")).orderBy("doc_id").collect()
    assert np.allclose([row.score for row in found], ensemble.scores(table))
    for row, values in zip(found, table, strict=True):
        against = [str(rule) for _, rule in sorted(zip(ensemble.weights, ensemble.rules), key=lambda pair: pair[0]) if _ < 0 and rule.holds(values[None])[0]]
        assert sorted(row.reasons) == sorted(against)


@pytest.mark.parametrize("label", [[], [1], [0, 0, 0], [1] * 9])
def test_labels_of_one_kind_give_one_score(label):
    ensemble = rules.fit(np.zeros((len(label), len(rules.STATISTICS))), np.array(label, int))
    assert ensemble.rules == [] and ensemble.scores(np.zeros((1, len(rules.STATISTICS))))[0] == pytest.approx((sum(label) + 1) / (len(label) + 2))


def labelled():
    rows, labels = [], []
    for i in range(1200):
        bad = i % 4 == 0
        rows.append((i, " ".join(word + random.Random(i).choice(["##", "$$"]) * bad for word in prose(i, 60).split()), "en" if bad else "de", "a", 0))
        labels.append((i, 0 if bad else 1, 0))
    return rows, labels


def test_labels_teach_and_the_held_out_fold_does_not(spark):
    rows, labels = labelled()
    documents = spark.createDataFrame(rows, SCHEMA)
    extra = [(0, 0, 1), (0, 1, 1), (0, 0, 1), (None, 1, 0), (5, None, 0), (10**9, 1, 0)]
    scores = lambda known: {r.doc_id: r for r in rules.quality_scores(documents, spark.createDataFrame(known, LABELS)).collect()}
    found = scores(labels + extra)
    assert np.mean([found[i].predicted == quality for i, quality, _ in labels]) > 0.98
    assert all(found[i].held_out == held(i) and 0 <= found[i].score <= 1 and found[i].predicted == (found[i].score >= 0.7) for i, _, _ in labels)
    assert found[0].reasons and not found[1].reasons
    turned = [(i, 1 - quality if held(i) else quality, toxic) for i, quality, toxic in labels + extra if quality is not None]
    assert {i: r.score for i, r in scores(turned).items()} == {i: r.score for i, r in found.items()}


def test_the_sample_is_bounded_and_does_not_depend_on_order(spark):
    labels = spark.range(5000).selectExpr("id AS doc_id", "CAST(id % 3 > 0 AS INT) AS quality", "0 AS toxic")
    chosen = rules.chosen_labels(labels, 300)
    assert 200 < chosen.count() <= 300
    again = rules.chosen_labels(labels.orderBy(F.desc("doc_id")).repartition(5), 300)
    assert Counter(map(tuple, chosen.collect())) == Counter(map(tuple, again.collect()))
    assert not any(held(row.doc_id) for row in chosen.collect())


def test_odd_documents_and_nothing(spark):
    labels = spark.createDataFrame([(row[0], i % 2, 0) for i, row in enumerate(odd_rows())], LABELS)
    found = rules.quality_scores(with_clashes(odd_documents(spark)).repartition(3), labels).collect()
    assert Counter(r.doc_id for r in found) == Counter(row[0] for row in odd_rows())
    assert all(0 <= r.score <= 1 and r.held_out == held(r.doc_id) for r in found)
    assert rules.quality_scores(empty_documents(spark), labels).collect() == []
    assert {r.score for r in rules.quality_scores(odd_documents(spark), labels.limit(0)).collect()} == {0.5}


def test_the_query_ranks_held_out_documents(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality")
    found = op13_quality_classifier(spark, SF).join(labels, "doc_id").where("held_out").select("score", "quality").toPandas()
    good, bad = (found.score[found.quality == kind].to_numpy() for kind in (1, 0))
    order = (good[:, None] > bad).mean() + (good[:, None] == bad).mean() / 2
    assert order > 0.99 and (good >= 0.7).mean() > 0.97 and (bad < 0.7).mean() > 0.9
