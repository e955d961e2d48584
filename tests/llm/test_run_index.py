"""Long matches against every window of every text, and the run-length index against plain suffix comparisons."""

import hashlib
from collections import Counter

import numpy as np
import pytest

from panelwave.llm import run_index


def expected(rows, length):
    texts = [(i, (t or "").encode()) for i, t in rows]
    count = Counter(b[k : k + length] for _, b in texts for k in range(len(b) - length + 1))
    out = []
    for i, b in texts:
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - length + 1):
            if count[b[k : k + length]] > 1:
                gone[k : k + length] = True
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        spans = int((gone & ~np.append([False], gone[:-1])[: len(gone)]).sum())
        out.append((i, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest(), kept))
    return out


def corpus(seed: int = 3) -> list[tuple]:
    rng = np.random.default_rng(seed)
    words = [bytes(rng.integers(97, 123, rng.integers(2, 9), np.uint8)).decode() for _ in range(300)]
    prose = lambda n: " ".join(rng.choice(words, n))
    shared, edge = prose(40), prose(300)
    rows = [(k, prose(int(rng.integers(0, 120)))) for k in range(30)]
    rows += [(100 + k, f"{prose(int(rng.integers(0, 30)))} {shared} {prose(int(rng.integers(0, 30)))}") for k in range(25)]
    rows += [(200 + k, edge[k * 7 : k * 7 + 200 - k % 3]) for k in range(20)]
    long = prose(400)
    rows += [(300 + k, long[: 500 + 50 * k] + prose(3) + long[500 + 50 * k :]) for k in range(6)]
    rows += [(400, "ab" * 900), (401, "a" * 700), (402, "xyz" + "a" * 250), (403, "é東" * 200), (404, long * 2), (405, "\x00" * 400)]
    return [*rows, (None, None), (None, ""), (300, rows[81][1]), (300, rows[81][1]), (301, "short")]


SCHEMA = "doc_id long, text string"


@pytest.mark.parametrize("group_nodes", [1, 4, run_index.GROUP_NODES])
@pytest.mark.parametrize("length", [128, 400])
def test_equals_every_window(spark, length, group_nodes):
    rows = corpus()
    docs = spark.createDataFrame([(i, t, 1, "z") for i, t in rows], SCHEMA + ", th int, `key` string").repartition(3)
    got = run_index.without_long_matches(docs, length=length, keep_text=True, group_nodes=group_nodes)
    order = lambda r: (r[0] is None, r)
    have = sorted(((*tuple(r)[:-1], bytes(r["kept"])) for r in got.collect()), key=order)
    assert have == sorted(expected(rows, length), key=order)


def test_empty_table(spark):
    got = run_index.without_long_matches(spark.createDataFrame([], SCHEMA))
    assert got.collect() == []
    assert got.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]


def test_runs_hold_the_transform_and_its_statistics():
    rng = np.random.default_rng(1)
    base = bytes(rng.integers(97, 100, 60, np.uint8))
    regions = [base, base[:30] + b"\x00" + base[30:], b"a", b"", base[10:], b"aaaaaaaaaaaaaaaaaaaa", b"\xff\xfe" * 9]
    index = run_index.RunIndex(regions)
    assert index.lengths.sum() == sum(map(len, regions)) + len(regions)
    assert len(index.symbols) < index.lengths.sum() / 2  # repeats share runs
    suffixes = [(r[k:], n, k) for n, r in enumerate(regions) for k in range(len(r) + 1)]

    def common(x, y):
        k = 0
        while k < min(len(x), len(y)) and x[k] == y[k]:
            k += 1
        return k

    best = np.zeros(index.lengths.sum(), np.int64)
    for place, _, match, reach in index.statistics():
        for p, m, r in zip(place, match, reach, strict=True):
            best[p : p + r] = np.maximum(best[p : p + r], m - np.arange(r))
    want = [max(common(s, t) for t, o, j in suffixes if (o, j) != (n, k)) for s, n, k in suffixes]
    assert np.maximum(best, 0).tolist() == want


def test_every_window_holds_its_anchor_at_the_same_offset():
    rng = np.random.default_rng(2)
    data = bytes(rng.integers(97, 99, 3000, np.uint8)) + b"abc" * 500
    places, keys, begins, ends = run_index.anchors(data, 200)
    hashes = run_index.gram_hashes(data, run_index.GRAM)
    width = 200 - run_index.GRAM + 1
    want = [k + width - 1 - int(np.argmin(hashes[k : k + width][::-1])) for k in range(len(data) - 199)]
    got = [p for p, a, b in zip(places, begins, ends, strict=True) for _ in range(a, b - 199)]
    assert got == want  # in order, each window in one range
    assert (hashes[places] == keys).all()
