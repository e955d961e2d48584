"""Source divergence against whole-number arithmetic in plain Python."""

import re
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest

from panelwave.llm import divergence

WORDS = "alpha beta gamma delta épée Ünit zeta eta theta iota kappa lambda".split()


def rows_of(seed: int, n: int) -> list[tuple]:
    rng = np.random.default_rng(seed)
    rows = []
    for k in range(n):
        source = [None, "", "a", "B", "ß", "src9"][rng.integers(6)]
        lang = [None, "en", "de"][rng.integers(3)]
        size = int(rng.integers(0, 25))
        rows.append((k // 2, " ".join(rng.choice(WORDS, size, p=np.arange(1, 13) / 78)).title() if size else None, lang, source, 1))
    return [*rows, *rows[:5], (9, "Alpha_beta9alpha " * 3000, "en", "a", 1), (None, "", "fr", None, 1), (None, None, "fr", "x", 1)]


def expected(rows: list[tuple], least_docs: int = 10, most: int = 10) -> list[tuple]:
    docs = [(r[2] or "", r[3] or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), r[1] or ""))) for r in rows]
    held, count = defaultdict(Counter), defaultdict(Counter)
    for lang, source, words in docs:
        held[lang].update(set(words))
        count[lang, source].update(words)
    out = []
    for lang in {d[0] for d in docs}:
        kept = [t for t, n in held[lang].items() if n >= least_docs]
        sources = sorted({d[1] for d in docs if d[0] == lang})

        def shares(counts):
            total = sum(counts[t] for t in kept)
            return {t: 1 + 10**9 * (counts[t] + 2) // (total + 2 * len(kept)) for t in kept}

        p = {s: shares(count[lang, s]) for s in sources}
        whole = shares(sum((count[lang, s] for s in sources), Counter()))
        f = lambda x, y: (x - y) ** 2 // (x + y)
        for s in sources:
            pairs = [(o, sum(f(p[s][t], p[o][t]) for t in kept)) for o in sources if o != s]
            terms = [(t, f(p[s][t], whole[t])) for t in kept if count[lang, s][t] and p[s][t] > whole[t]]
            for part, items, top in (("pair", pairs, len(pairs)), ("term", terms, most)):
                for rank, (item, value) in enumerate(sorted(items, key=lambda x: (-x[1], x[0].encode()))[:top], 1):
                    out.append((lang, s, part, item, value, rank))
    return sorted(out)


SCHEMA = "doc_id long, text string, lang string, source string, term int"


@pytest.mark.parametrize("n", [0, 7, 160])
def test_equals_plain_arithmetic(spark, n):
    rows = rows_of(n, n) if n else []
    got = divergence.source_divergence(spark.createDataFrame(rows, SCHEMA))
    assert sorted(map(tuple, got.collect())) == expected(rows)


@pytest.mark.parametrize("dense", [1, 4, 10_000])
def test_product_is_the_same_dense_and_sparse(monkeypatch, dense):
    monkeypatch.setattr(divergence, "DENSE_TERMS", dense)
    monkeypatch.setattr(divergence, "DENSE_COLUMNS", 3)
    monkeypatch.setattr(divergence, "PAIRS_AT_ONCE", 16)
    rng = np.random.default_rng(5)
    rows = pd.DataFrame([(t, g, g // 3, int(rng.integers(1, 4))) for t in range(60) for g in range(6) if rng.random() < 0.7], columns=["term", "g", "part", "n"])
    for i, j in ((0, 0), (0, 1), (1, 1)):
        tile = rows[rows["part"].isin([i, j])].assign(tile_i=i, tile_j=j)
        got = Counter()
        for a, la, b, lb, n in divergence.block_product(tile).itertuples(index=False):
            got[a, la, b, lb] += n
        want = Counter()
        for _, same in tile.groupby("term"):
            for x in same.itertuples():
                for y in same.itertuples():
                    if x.g < y.g and (x.part, y.part) == (i, j):
                        want[x.g, x.n, y.g, y.n] += 1
        assert got == want


def test_joint_tables_count_every_term_once(spark):
    levels = spark.createDataFrame([("en", 0, "x", 2), ("en", 1, "x", 3), ("en", 1, "y", 3), ("en", 0, "z", 1)], "lang string, g int, term string, n long")
    groups = spark.createDataFrame([("en", 0, 5), ("en", 1, 5), ("de", 0, 0)], "lang string, g int, terms long")
    got = {(r.a_level, r.b_level): r.terms for r in divergence.joint_tables(levels, groups).collect()}
    assert got == {(2, 3): 1, (0, 3): 1, (1, 0): 1, (0, 0): 2}
