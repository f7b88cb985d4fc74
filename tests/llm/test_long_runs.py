import math
import random
import re
import string
import time

from docketframe.llm import secrets
from tests.llm.test_scans import base_spans, entropy_spans, line

rng = random.Random(5)
SHORT = "".join(rng.choices(string.ascii_letters + string.digits + "+/", k=300))
RUNS = {
    "paths": ("ab/" * 34_000, False),
    "numbers": ("12-" * 34_000 + "1", False),
    "numbers, cut": ("12-" * 34_000, False),
    "dashes": ("-" * 100_000 + "1", False),
    "words": ("abcXYZ" * 17_000, False),
    "base64": ("".join(rng.choices(string.ascii_letters + string.digits + "+/", k=100_000)), True),
    "one letter, then random": ("b+" * 50_000 + SHORT[:40], True),
}


def test_runs_of_100_kb(spark):
    names = list(RUNS)
    documents = spark.createDataFrame([(at, f"x {RUNS[name][0]} y") for at, name in enumerate(names)], "doc_id long, text string")
    before = time.monotonic()
    for row in secrets.secret_report(documents).collect():
        run, secret = RUNS[names[row.doc_id]]
        assert row.spans == (f"entropy:2:{2 + len(run)}" if secret else ""), names[row.doc_id]
    assert time.monotonic() - before < 120


def test_window_entropy_of_a_short_run(spark):
    def bits(part):
        return -sum(n / secrets.WINDOW * math.log2(n / secrets.WINDOW) for n in map(part.count, set(part)))

    best = max(bits(SHORT[i : i + secrets.WINDOW]) for i in range(len(SHORT) - secrets.WINDOW + 1))
    frame = spark.createDataFrame([(SHORT,)], "run string")
    assert abs(frame.select(secrets.window_entropy(frame.run)).first()[0] - best) < 1e-9


def test_runs_of_letters_digits_and_separators(spark):
    draw = random.Random(7)
    texts = ["".join(draw.choices(alphabet, k=draw.randint(18, 40))) for alphabet in ("ab/-", "0123/-", "aZ9_", "0123456789/", "abc_XYZ/-k") for _ in range(60)]
    for row in secrets.secret_report(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect():
        base = base_spans(texts[row.doc_id])
        assert row.spans == line(sorted(base + list(entropy_spans(texts[row.doc_id], base))))


def test_the_allow_list_knows_what_repeated_groups_know():
    groups = r"[A-Za-z]+|[0-9]+|[A-Za-z]*(?:[/_-]+[A-Za-z]*)+|[0-9]+(?:[/_-]+[0-9]+)+"
    draw = random.Random(9)
    for _ in range(5000):
        run = "".join(draw.choices(draw.choice(("a/", "1/", "1-", "a1/", "aB_-")), k=draw.randint(1, 12)))
        assert bool(re.fullmatch(groups, run)) == any(re.fullmatch(pattern, run) for pattern in secrets.ALLOWED[:2]), run
