import re
from collections import Counter
from math import comb

import numpy as np
import pytest
from pyspark.sql import functions as F

from docketframe.llm import quality_rules as rules
from tests.llm.odd import empty_documents, odd_documents, odd_rows, prose, with_clashes

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LABELS = "doc_id long, quality int, toxic int"


def counts(text):
    text = text or ""
    words, lines = WORD.findall(text), [line for line in text.split("\n") if WORD.search(line)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {i + k for i, window in enumerate(windows) if often[window] > 1 for k in range(3)}
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), failed


EXTRA = ["a b c a b c", "x\ny\nx\n\n \nx", "# * $a|b <> é 😀", "one two " * 40, "a\x0bb\x0cc\rd\x1ce", "w " * 3, "p q r s " * 30 + prose(1, 60)]


def test_counts_match_brute_force(spark):
    texts = EXTRA + [row[1] for row in odd_rows()]
    documents = with_clashes(spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string"))
    rows = rules.quality_report(documents, spark.createDataFrame([], LABELS)).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == counts(texts[r.doc_id])
        assert r.kept == (not r.base_failed) and list(r.broken) == []


def test_tail_is_the_binomial_sum():
    for hits, n, share in ((0, 10, 0.1), (3, 50, 0.04), (7, 200, 0.02)):
        exact = sum(comb(n, k) * share**k * (1 - share) ** (n - k) for k in range(hits + 1))
        assert rules.tail(hits, n, share) == pytest.approx(exact)
    assert rules.tail(9, 9, 0.5) == 1 and rules.tail(50_000_000, 10**9, 0.05) == pytest.approx(0.5, abs=1e-3)


def test_a_text_counts_once_however_often_it_is_labelled(spark):
    rows, labels = labelled_rows()
    copies = [(10_000 + i, rows[1][1], "en", "a", 0) for i in range(3000)]
    frame = lambda found: spark.createDataFrame(found, "doc_id long, text string, lang string, source string, n_chars long")
    chosen = []
    for extra in ([], copies):
        measured = rules.measures(frame(rows + extra)).withColumn("base_failed", F.lit(False))
        known = spark.createDataFrame(labels + [(row[0], 1, 0) for row in extra], LABELS)
        chosen.append({(r.lang, r.rule): r.cutoff for r in rules.cutoffs(measured, known).collect()})
    assert chosen[0] == chosen[1] and chosen[0]


def test_chosen_cutoffs_against_brute_force():
    rng = np.random.default_rng(11)
    for _ in range(30):
        good, bad = rng.integers(0, 400, rules.GRID + 1) * (np.arange(rules.GRID + 1) < 12), rng.integers(0, 40, rules.GRID + 1)
        n, certain = int(good.sum()), []
        for at in range(rules.GRID - 1, -1, -1):
            above = int(good[at + 1 :].sum())
            exact = sum(comb(n, k) * 0.02**k * 0.98 ** (n - k) for k in range(above + 1)) if above <= 60 else 1.0
            if above > n * 0.02 or exact > 0.01:
                break
            certain.append((int(bad[at + 1 :].sum()) - rules.GOOD_WEIGHT * above, at))
        best = [at for use, at in certain if use == max(certain)[0]] if certain and max(certain)[0] > 0 else []
        assert rules.cutoff(good, bad, 0.02, 0.01) == (best[len(best) // 2] if best else None)
    assert not rules.certified(0, 10, 0.01, 0.05) and rules.certified(0, 300, 0.01, 0.05)


def test_cutoffs_rarely_lose_more_good_documents_than_allowed():
    rng = np.random.default_rng(3)
    exceeded = 0
    for _ in range(300):
        chances = np.cumprod(np.full(rules.GRID, 0.9))
        chances /= chances.sum()
        bad = np.full(rules.GRID + 1, 10**6)
        found = rules.cutoff(rng.multinomial(2000, np.append(chances, 0)), bad, 0.02, 0.05)
        exceeded += found is not None and chances[found + 1 :].sum() > 0.02
    assert exceeded <= 0.05 * 300 + 12
    none = np.zeros(rules.GRID + 1, int)
    assert rules.cutoff(none, none + 5, 0.02, 0.05) is None


def test_the_middle_of_equally_useful_cutoffs_is_taken_and_useless_ones_are_not():
    good, bad = np.zeros(rules.GRID + 1, int), np.zeros(rules.GRID + 1, int)
    good[:11] = 1000
    bad[40] = 50
    assert 20 <= rules.cutoff(good, bad, 0.02, 0.05) <= 30
    assert rules.cutoff(good, good, 0.02, 0.05) is None


def labelled_rows():
    """Two strata: in one, bad documents are full of symbols and good ones are not; the other has few labels."""
    rows, labels = [], []
    for i in range(4000):
        bad = i % 10 == 0
        rows.append((i, prose(i, 60) + (" ##" * 40 if bad else ""), "en", "a", 0))
        labels.append((i, 0 if bad else 1, 0))
    for i in range(4000, 4040):
        rows.append((i, prose(i, 60) + " ##" * 40, None, "a", 0))
        labels.append((i, 0, 0))
    return rows, [*labels, (0, 0, 1), (None, 1, 0), (999_999, 1, 0), (5, None, None), (4000, 1, 0)]


def test_rules_turn_away_the_bad_of_a_stratum_with_enough_labels(spark):
    rows, labels = labelled_rows()
    documents = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    found = {r.doc_id: r for r in rules.quality_report(documents, spark.createDataFrame(labels, LABELS)).collect()}
    assert not any(found[i].kept for i in range(0, 4000, 10))
    assert np.mean([found[i].kept for i in range(4000) if i % 10]) > 1 - rules.RISK
    assert all(found[i].kept != found[i].base_failed for i in range(4000, 4040)), "a stratum with few labels turns nothing away"
    assert any("symbols" in found[i].broken for i in range(0, 4000, 10))


def test_odd_documents_and_nothing(spark):
    labels = spark.createDataFrame([(row[0], 1, 0) for row in odd_rows()], LABELS)
    rows = rules.quality_report(with_clashes(odd_documents(spark)), labels).collect()
    assert Counter(r.doc_id for r in rows) == Counter(row[0] for row in odd_rows())
    assert rules.quality_report(empty_documents(spark), labels).collect() == []
