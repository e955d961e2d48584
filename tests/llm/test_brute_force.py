"""Operators that SQL cannot express, against brute force on small tables."""

from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from panelwave.llm import cap_filters, decontaminate, langid, simhash_dedup, token_files
from panelwave.llm.components import components
from panelwave.llm.queries import tokenizer_path


def least_reachable(links, nodes):
    root = {n: n for n in nodes}

    def up(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = up(a), up(b)
        root[max(a, b)] = min(a, b)
    return {n: up(n) for n in nodes}


@pytest.mark.parametrize("rows", [40, 2048])
def test_vectors(spark, rows):
    rng = np.random.default_rng(4)
    centres = rng.standard_normal((30, 16))
    x = np.concatenate([centres[rng.integers(0, 30, 250)] + 0.22 * rng.standard_normal((250, 16)), centres[:1].repeat(60, axis=0)])
    df = spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)], "vec_id long, embedding array<double>")
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    close = unit @ unit.T >= 0.9
    np.fill_diagonal(close, False)
    roots = least_reachable(zip(*np.nonzero(close), strict=True), range(len(x)))
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in cap_filters.near_vectors(df, group_rows=rows).collect()}
    assert got == {i: (close[i].sum(), roots[i], roots[i] == i) for i in range(len(x))}


@pytest.mark.parametrize("words", [128, 1024])
def test_vectors_share_filters(words):
    rng = np.random.default_rng(8)
    u, side = cap_filters.unit_rows(rng.standard_normal((1000, 64))), rng.standard_normal((1000, 64))
    side = cap_filters.unit_rows(side - (side * u).sum(axis=1, keepdims=True) * u)
    code = cap_filters.Code(words)
    found = [set(zip(*(x.tolist() for x in cap_filters.decode(code, v)), strict=True)) for v in (u, 0.9 * u + np.sqrt(0.19) * side)]
    shared = np.bincount([row for row, _ in found[0] & found[1]], minlength=1000)
    assert (shared == 0).sum() <= 2 and shared.mean() >= 25


def test_vectors_many_directions(spark):
    rng = np.random.default_rng(9)
    x = np.repeat(cap_filters.unit_rows(rng.standard_normal((60, 64))), 4, axis=0)
    x += 0.29 / 8 * rng.standard_normal(x.shape)
    close = (unit := cap_filters.unit_rows(x)) @ unit.T >= 0.9
    df = spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)], "vec_id long, embedding array<double>")
    got = {r["vec_id"]: r["n_links"] for r in cap_filters.near_vectors(df, code=cap_filters.Code(1024)).collect()}
    assert got == {i: close[i].sum() - 1 for i in range(len(x))} and sum(got.values()) > 300


def plain_fingerprint(text):
    words = [w for w in "".join(c.lower() if c.isascii() else c for c in text).replace("\t", " ").replace("\n", " ").split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[k : k + 4]) for k in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("rows", [3, 2048])
def test_simhash(spark, rows):
    rng = np.random.default_rng(5)
    texts = []
    for _ in range(25):
        words = [f"W{v}" for v in rng.integers(0, 500, 60)]
        for _ in range(6):
            near = list(words)
            near[int(rng.integers(0, 60))] = "É"
            texts.append(" ".join(near))
    fps = [plain_fingerprint(t) for t in texts]
    assert fps == [simhash_dedup.fingerprint(t) for t in texts]
    pairs = [(a, b) for a in range(len(fps)) for b in range(a) if (fps[a] ^ fps[b]).bit_count() <= 4]
    roots = least_reachable(pairs, range(len(fps)))
    prints = spark.createDataFrame([(i, f if f < 1 << 63 else f - (1 << 64)) for i, f in enumerate(fps)], "i long, fp long")
    links = simhash_dedup.links(prints.select("fp").distinct(), group_rows=rows)
    heads = {r["node"]: r["root"] for r in components(links, "a", "b").collect()}
    signed = [r["fp"] for r in prints.orderBy("i").collect()]
    groups = {}
    for i, f in enumerate(signed):
        groups.setdefault(heads.get(f, f), set()).add(roots[i])
    assert all(len(g) == 1 for g in groups.values()) and len(groups) == len(set(roots.values()))


def test_first_of_similar(spark):
    rng = np.random.default_rng(7)
    texts = []
    for _ in range(40):
        words = [f"W{v}" for v in rng.integers(0, 500, int(rng.integers(60, 200)))]
        texts.append(words)
        for changes in (1, 2, 3, 4, 5, 8):
            near = list(words)
            for k in rng.integers(0, len(near), changes):
                near[int(k)] = "É"
            texts.append(near)
    sets = [{tuple(" ".join(t).lower().split()[i : i + 5]) for i in range(len(t) - 4)} for t in texts]

    def similar(rows):
        return [(a, b) for a in rows for b in rows if b < a and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.8]

    df = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    first = sorted(r["doc_id"] for r in simhash_dedup.first_of_each(df).collect())
    roots = least_reachable(similar(first), first)
    kept = sorted(r["doc_id"] for r in corpus_pipeline.drop_near_copies(spark, df, "").collect())
    assert similar(first) and kept == sorted(set(roots.values()))


@pytest.mark.parametrize("part_bytes", [700, 4000, simhash_dedup.PART_BYTES])
def test_similar_links_join_what_pairs_join(spark, part_bytes):
    rng = np.random.default_rng(11)
    texts = []
    for size in (40, 25, 3, 1):
        words = [f"w{v}" for v in rng.integers(0, 900, 90)]
        for k in range(size):
            near = list(words)
            near[k % 90] = f"x{k}"
            texts.append(near[: 90 - k // 8])
    texts += [texts[0][:-1] + ["end"], texts[0], ["one"], ["two"], [], ["ONE"]]
    sets = [{tuple(" ".join(t).lower().split()[i : i + 5]) for i in range(max(len(t) - 4, min(len(t), 1)))} for t in texts]
    pairs = [(a, b) for a in range(len(texts)) for b in range(a) if sets[a] and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.8]
    want = least_reachable(pairs, range(len(texts)))
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    names = {r.th: r.ids for r in df.selectExpr("xxhash64(text) AS th", "doc_id").groupBy("th").agg(F.collect_list("doc_id").alias("ids")).collect()}
    links, roots = simhash_dedup.similar_groups(df, part_bytes=part_bytes)
    found = [(r.a, r.b) for r in links.collect()]
    assert all((max(x, y), min(x, y)) in set(pairs) or x == y for a, b in found for x in names[a][:1] for y in names[b][:1])
    same = [(ids[0], i) for ids in names.values() for i in ids]
    got = least_reachable([(names[a][0], names[b][0]) for a, b in found] + same, range(len(texts)))
    assert got == want
    placed = {r.node: r.root for r in roots.collect()}
    assert {i: min(j for n in names if placed.get(n, n) == placed.get(th, th) for j in names[n]) for th, ids in names.items() for i in ids} == want
    assert len(found) <= 24 * len(texts)  # at most one for each membership in a band


def test_decontamination(spark):
    rng = np.random.default_rng(6)
    items = [[f"w{v}" for v in rng.integers(0, 12, n)] for n in (9, 14, 20, 30)]
    docs = []
    for k in range(60):
        words = [f"w{v}" for v in rng.integers(0, 12, 50)]
        item = list(items[k % 4])
        for _ in range(k % 3):
            item[int(rng.integers(0, len(item)))] = "x"
        docs.append(words[: k % 25] + item[k % 2 :] + words[25 - k % 7 :])

    def shingles(words):
        return Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))

    want = {}
    for d, words in enumerate(docs):
        for i, item in enumerate(items):
            own = shingles(item)
            starts = range(max(1, len(words) - len(item) + 1))
            best = max((sum((own & shingles(words[s : s + len(item)])).values()) / own.total(), -s) for s in starts)
            if best[0] >= 0.8:
                want[d, i] = round(best[0], 9)
    table = lambda rows, name: spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(rows)], f"{name} long, text string")
    hits = decontaminate.contaminated(table(docs, "doc_id"), table(items, "item_id")).collect()
    assert {(r["doc_id"], r["item_id"]): round(r["similarity"], 9) for r in hits} == want and want


def test_coding_round_trip():
    ranks = np.array([0, 255, 256, 65535, 65536, 1 << 24, (1 << 32) - 1, 7, 1], np.uint32)
    for n in range(len(ranks) + 1):
        assert (token_files.decoded(*token_files.coded(ranks[:n]), n) == ranks[:n]).all()
    assert token_files.decoded(b"", b"", 0).size == 0


def test_token_files_are_read_with_their_own_ranks(spark, tmp_path):
    docs = spark.createDataFrame([(1, "one two two"), (2, None), (3, "three")], "doc_id long, text string")
    encoded = token_files.encode(docs, tokenizer_path(), 2, "doc_id", "text")
    order, total = token_files.rank_order(encoded)
    shards = token_files.write_files(encoded, str(tmp_path / "files"), order, total)
    right = sorted(map(tuple, token_files.digest(shards).collect()))
    assert (token_files.read_ranks(str(tmp_path / "files")) == order).all()
    (tmp_path / "files" / "ranks").write_bytes(order[::-1].astype("<u4").tobytes())
    wrong = sorted(map(tuple, token_files.digest(shards).collect()))
    assert [r[:3] for r in wrong] == [r[:3] for r in right] and [r[3] for r in wrong] != [r[3] for r in right]


def test_language_of_texts_without_a_letter_and_of_many_languages(spark):
    names = [f"l{k:03d}" for k in range(420)]
    rows = [(k, f"{n} w{n}x " * 3, n) for k, n in enumerate(names)] + [(1000 + k, f"{names[0]} again", names[0]) for k in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.learn(docs, F.lit(True))
    assert len(model.dictionaries) == 400 and names[0] in model.dictionaries
    for text in ("́̂", "12 -- 3", "", None, "́ 7"):
        assert model.predict(text) == ("und", 0.0, True)
    assert model.predict("é")[0] != "und"
