"""Token alignment against offsets worked out for each document alone."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from panelwave.llm import alignment
from panelwave.llm.queries import tokenizer_path

A, B = "byte_bpe_50k.json", "piece_bpe_32k.model"
TEXTS = [
    "Hello world, unbelievable tokenizers!", "Hello world again  and   again\n\n\tdone", "", None, " leading", "naïve café 東京都 😀😀 é",
    "<|endoftext|> is plain <s> text </s>", "under▁score piece", "a" * 3000, "東京" * 400, "Hello world, unbelievable tokenizers!",
    "\x00\x01 control", "x=1;y=2;" * 40, "=" * 131, "word " * 5000,
]


def groups_of(a, b):
    """Token positions cut at the offsets where both end."""

    def ends(pieces):
        out, at = [], 0
        for p in pieces:
            at += len(p)
            out.append(at)
        return out

    ea, eb = ends([p for _, p in a]), ends([p for _, p in b])
    out, i, j = [], 0, 0
    for stop in sorted(set(ea) & set(eb)):
        x, y = [], []
        while i < len(a) and ea[i] <= stop:
            x.append(a[i][0])
            i += 1
        while j < len(b) and eb[j] <= stop:
            y.append(b[j][0])
            j += 1
        out.append((x, y))
    return out


def expected(rows):
    tok, va, _ = alignment.byte_level(tokenizer_path(A))
    model, vb = alignment.piece_level(tokenizer_path(B))
    docs = []
    for i, text in rows:
        a = [(t, va.pieces[t]) for t in tok.encode(f" {text}", add_special_tokens=False).ids] if text else []
        b = [(t, vb.pieces[t]) for t in model.encode(text)] if text else []
        whole = f" {text}".encode()
        if b"".join(p for _, p in a) != whole or b"".join(p for _, p in b) != whole:
            a, b = [], []
        docs.append((i, a, b, groups_of(a, b)))
    links = [[(x, y) for of_a, of_b in d[3] for x in of_a for y in of_b] for d in docs]
    count = Counter(pair for each in links for pair in set(each))
    best = defaultdict(int)
    for (x, _), n in count.items():
        best[x] = max(best[x], n)
    out = []
    for (i, a, b, groups), each in zip(docs, links, strict=True):
        text = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
        digest = hashlib.sha256(text.encode()).hexdigest() if a else ""
        out.append((i, len(a), len(b), len(groups), len(each), sum(count[k] == best[k[0]] for k in each), sum(count[k] for k in each), digest, text))
    return out


@pytest.fixture(scope="module")
def rows():
    return [(None if k == 6 else k // 2, t) for k, t in enumerate(TEXTS)]


def test_equals_offsets_of_each_document(spark, rows, monkeypatch):
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, pairs string, chunk int").repartition(3)
    got = alignment.aligned(docs, tokenizer_path(A), tokenizer_path(B), keep_groups=True)
    order = lambda r: (r[0] is None, r)
    assert sorted(map(tuple, got.collect()), key=order) == sorted(expected(rows), key=order)


def test_the_tables_hold_texts_that_do_not_spell(rows):
    assert {r[1] for r in expected(rows) if r[1] == 0} == {0}
    assert sum(r[1] == 0 for r in expected(rows)) >= 3


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    got = alignment.aligned(docs, tokenizer_path(A), tokenizer_path(B))
    assert got.collect() == []
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_byte_characters_cover_every_byte():
    of = alignment.byte_characters()
    assert sorted(of.values()) == list(range(256))
    assert of["Ġ"] == 32 and of["Ċ"] == 10


def test_both_encoders_of_a_agree():
    aligner = alignment.aligner(tokenizer_path(A), tokenizer_path(B))
    rng = np.random.default_rng(7)
    settled = [chr(c) for c in range(0x250) if alignment.SETTLED.fullmatch(chr(c))] + list("\u2014\u2019\u201c") * 3 + list(" 'sstre  \n") * 9
    for _ in range(4000):
        text = "".join(rng.choice(settled, rng.integers(0, 60)))
        assert alignment.SETTLED.fullmatch(text)
        assert aligner.ranked.encode_ordinary(text) == aligner.a.encode(text, add_special_tokens=False).ids
    for text in ("a" * 5000, " " * 3000, "ab " * 900, "\n\n \n" * 500, "é" * 999, "<|endoftext|>" * 50):
        assert aligner.ranked.encode_ordinary(text) == aligner.a.encode(text, add_special_tokens=False).ids


def test_words_are_encoded_once_and_as_in_their_texts(monkeypatch):
    aligner = alignment.Aligner(tokenizer_path(A), tokenizer_path(B))
    given, encode = [], aligner.encode
    monkeypatch.setattr(aligner, "encode", lambda texts: encode(given.append(list(texts)) or texts))
    for texts in (["alpha beta alpha", "beta alpha"], ["beta beta"]):
        aligner.segments(texts)
    assert sorted(w for words in given for w in words) == ["alpha", "beta"]

    rng = np.random.default_rng(11)
    letters = list(" " * 12 + "aabcst'\u2019\u00e9\u6771\n\t\u00a0\u2003\u258115.,=<|>\x1c\x85\u3000\u0301\U0001f600") + ["'s", "<s>", "<|endoftext|>"]
    texts = ["".join(rng.choice(letters, rng.integers(1, 16))) for _ in range(5000)]
    for text, own in zip(texts, aligner.segments(texts), strict=True):
        ((a, b),) = encode([text])
        digest = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups_of(
            [(i, aligner.vocabulary_a.pieces[i]) for i in a], [(i, aligner.vocabulary_b.pieces[i]) for i in b]
        ))
        assert ";".join(s.text for s in own) == digest
        assert sum(np.frombuffer(s.counts, np.int64)[0] for s in own) == len(a)
