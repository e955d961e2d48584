"""The pipeline, stage by stage, against plain Python on planted documents."""

import random
from collections import Counter, defaultdict

from tokenizers import Tokenizer

import corpus_pipeline
from panelwave.llm.common import stored
from panelwave.llm.queries import tokenizer_path

FIELDS = "doc_id long, text string, lang string, source string, n_chars long"
VILE = ["zorgle", "blarnak", "vexitor", "grumqua"]


def planted():
    """Rows, labels, benchmark items, and the ids that each of the first three stages must drop."""
    rng = random.Random(12)
    vocabulary = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(3, 8))) for _ in range(3000)]
    words = lambda n: rng.choices(vocabulary, k=n)
    texts, labels, toxic, copies, leaks = {}, [], set(), set(), set()
    for i in range(240):
        body = words(rng.randint(70, 140))
        if i % 4 == 0:
            for w in VILE:
                body.insert(rng.randrange(len(body)), w)
            toxic.add(i)
        texts[i] = " ".join(body)
        # Every tenth document has no label.
        if i % 10:
            labels.append((i, 1, int(i % 4 == 0)))
    items = [(k, " ".join(words(rng.randint(20, 40)))) for k in range(6)]
    for k in range(12):
        near = texts[4 * k + 1].split()
        if k % 3:
            near[rng.randrange(len(near))] = "otherword"
        texts[300 + k] = " ".join(near)
        copies.add(300 + k)
    for k, item in items:
        body = words(100)
        texts[400 + k] = " ".join([*body[:40], *item.split(), *body[40:]]).upper()
        leaks.add(400 + k)
    # Half of an item is no leak.
    texts[410] = " ".join([*words(60), *items[0][1].split()[:8], *words(60)])
    sources = lambda i: ["big", "mid", None][0 if i % 8 < 5 else 1 if i % 8 < 7 else 2]
    rows = [(i, t, "en", sources(i), len(t)) for i, t in texts.items()]
    return rows, labels, items, toxic, copies, leaks


def shingles(text):
    w = text.lower().split()
    return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))}


def first_of_similar(texts):
    """Smallest id of each class of texts at similarity 0.8 or more, by all pairs."""
    sets, root = {i: shingles(t) for i, t in texts.items()}, {i: i for i in texts}

    def up(i):
        return i if root[i] == i else up(root[i])

    for a in sets:
        for b in sets:
            if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                x, y = up(a), up(b)
                root[max(x, y)] = min(x, y)
    return {i for i in texts if up(i) == i}


def leaking(texts, items):
    """Ids of texts with a window of an item's size that shares 0.8 of its shingles, by all windows."""
    out = set()
    for _, item in items:
        want = Counter(tuple(item.lower().split()[k : k + 5]) for k in range(len(item.split()) - 4))
        for i, text in texts.items():
            w = text.lower().split()
            every = [tuple(w[k : k + 5]) for k in range(len(w) - 4)]
            for k in range(len(every)):
                have = Counter(every[k : k + sum(want.values())])
                if (have & want).total() >= 0.8 * want.total():
                    out.add(i)
                    break
    return out


def targets(sizes):
    """Words wanted of each source: weights 3, 1, 2 by name, 150 % in all, at most twice a source's size."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight, total, full = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}, 1.5 * sum(sizes.values()), set()
    while True:
        rest = total - sum(2 * sizes[s] for s in full)
        open_ = [s for s in names if s not in full]
        share = {s: rest * weight[s] / sum(weight[o] for o in open_) for s in open_}
        over = {s for s in open_ if share[s] > 2 * sizes[s]}
        if not over:
            return {s: 2.0 * sizes[s] for s in full} | share
        full |= over


def test_planted_documents(spark, tmp_path):
    rows, labels, items, toxic, copies, leaks = planted()
    docs = spark.createDataFrame(rows, FIELDS)
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    kept, at = {}, docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        at = stored(stage(spark, at, str(tmp_path)), f"test-{name}")
        assert at.columns == docs.columns
        kept[name] = [tuple(r) for r in at.collect()]
    every = {r[0]: r for r in rows}
    ids = {name: {r[0] for r in found} for name, found in kept.items()}
    assert all(every[r[0]] == r for found in kept.values() for r in found)

    assert set(every) - ids["toxicity"] == toxic
    texts = {i: every[i][1] for i in ids["toxicity"]}
    assert ids["simhash_dedup"] == first_of_similar(texts) == set(texts) - copies
    texts = {i: every[i][1] for i in ids["simhash_dedup"]}
    assert ids["simhash_dedup"] - ids["decontamination"] == leaking(texts, items) == leaks
    assert all(len(kept[n]) == len(ids[n]) for n in ("toxicity", "simhash_dedup", "decontamination"))

    size = {i: len(every[i][1].split()) for i in ids["decontamination"]}
    sizes, mixed = defaultdict(int), defaultdict(int)
    for i, n in size.items():
        sizes[every[i][3]] += n
    for r in kept["source_mix"]:
        mixed[r[3]] += size[r[0]]
    # To the nearest document, after blocks of 32 words.
    assert all(abs(mixed[s] - t) <= max(size.values()) + 32 for s, t in targets(sizes).items())
    assert max(Counter(r[0] for r in kept["source_mix"]).values()) <= 2

    tokens = corpus_pipeline.STAGES[-1][1](spark, at, str(tmp_path)).orderBy("start").collect()
    tokenizer = Tokenizer.from_file(tokenizer_path())
    want = sorted((r[0], len(tokenizer.encode(r[1], add_special_tokens=False).ids) + 1) for r in kept["source_mix"])
    assert [(r["doc_id"], r["n_tokens"]) for r in tokens] == want
    assert [r["start"] for r in tokens] == [sum(n for _, n in want[:k]) for k in range(len(want))]
