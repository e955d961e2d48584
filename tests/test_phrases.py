"""Many phrases by one automaton, against one pass of each pattern."""

import random
import re

import pytest

from panelwave.operators.textaudit import CLAIM_PATTERNS, Phrases, claims, folded, literal_start

ODD = (r"ab+", r"a|ka", r"(?:is|as)a", r"aba", r"s?k", r"ask.", r"[st]a", r"\bsi(k|a)*", r"kis?", r"is{2}", r"a{1}b", r"k(a|b)")


@pytest.mark.parametrize(
    ("pattern", "start"),
    [(r"\bcausa(n)?\b", "causa"), (r"pa[ií]s", "pa"), ("ab?c", "a"), ("a|b", ""), ("a(b|c)", "a"), (r"a[|]b", "a"), (r"a\|b", "a"), ("x?", ""), ("(?i)ab", ""), ("AB+", "ab"), (".a", ""), ("ab{0,2}", "a")],
)
def test_literal_start(pattern, start):
    assert literal_start(pattern) == start


def test_every_caseless_letter_is_folded():
    every = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    assert all(len(folded(c)) == 1 for c in every)
    for letter in "abcdefghijklmnopqrstuvwxyz":
        assert all(folded(c) == letter for c in re.findall(letter, "".join(every), re.IGNORECASE))


@pytest.mark.parametrize("patterns", [CLAIM_PATTERNS, ODD])
def test_equals_one_pass_of_each_pattern(patterns):
    rng = random.Random(5)
    parts = ["causa", "n", " ", "todo el país", "toda guatemala", "a nivel nacional", "\n", "los guatemaltecos", *"abskitSKİıſK.", *" " * 20]
    found = Phrases(patterns)
    hits = 0
    for _ in range(3000):
        text = "".join(rng.choices(parts, k=rng.randint(0, 30)))
        want = sorted((p, m.start(), m[0]) for p in patterns for m in re.finditer(p, text, re.IGNORECASE))
        assert sorted((p, m.start(), m[0]) for p, m in found.matches(text)) == want
        hits += len(want)
    assert hits > 1000


def test_no_patterns_and_empty_texts(spark):
    df = spark.createDataFrame([(1, "causa"), (2, ""), (3, None)], "id int, t string")
    assert claims(df, "id", "t", []).count() == 0
    assert [(r.id, r.start) for r in claims(df, "id", "t").collect()] == [(1, 0)]
