import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from holdfast.llm import suffix_dedup as S


@settings(max_examples=80, deadline=None)
@given(st.lists(st.tuples(st.text("ab", min_size=12, max_size=60), st.integers(1, 2)), min_size=1, max_size=6), st.sampled_from([9, 12, 20]))
def test_suffix_array_marks_what_repeats(parts, length):
    counts = Counter()
    for text, weight in parts:
        for k in range(len(text) - length + 1):
            counts[text[k : k + length]] += weight
    marks = S.marked_strings([t.encode() for t, _ in parts], [w for _, w in parts], length)
    for (text, _), ranges in zip(parts, marks):
        assert {k for a, b in ranges for k in range(a, b)} == {k for k in range(len(text) - length + 1) if counts[text[k : k + length]] > 1}


def test_equal_strings_have_equal_anchors():
    rng = np.random.default_rng(1)
    data = rng.integers(97, 99, 5000).astype(np.uint8)
    data[3000:3200] = data[100:300]
    first, count, place, anchor = S.anchor_runs(data, np.array([0, 2500]), np.array([2500, 5000]), 40, 12)
    found = {int(f) + k: (int(h), int(f + p) - int(f) - k) for f, c, p, h in zip(first, count, place, anchor) for k in range(c)}
    assert set(found) == set(range(2461)) | set(range(2500, 4961))
    assert all(found[100 + k] == found[3000 + k] for k in range(161))


def brute(df, length):
    docs = [(r.doc_id, (r.text or "").encode()) for r in df.collect()]
    counts = Counter(b[k : k + length] for _, b in docs for k in range(len(b) - length + 1))
    out = []
    for d, b in docs:
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if counts[b[k : k + length]] > 1:
                gone[k : k + length] = b"\1" * length
        spans = sum(g and (not k or not gone[k - 1]) for k, g in enumerate(gone))
        out.append((d, len(b), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest()))
    return sorted(out, key=repr)


def got(df, *args):
    return sorted((tuple(r) for r in S.dedup_suffixes(df, *args).collect()), key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force_with_hot_passages(spark, seed):
    rnd = random.Random(seed)
    words = ["".join(rnd.choice("abcdeé") for _ in range(rnd.randint(1, 6))) for _ in range(60)]
    base = " ".join(rnd.choice(words) for _ in range(60))
    docs = []
    for k in range(50):
        text = " ".join(rnd.choice(words) for _ in range(rnd.randint(0, 60)))
        if k % 2:
            text += base[: rnd.randint(60, 200)] + " ".join(rnd.choice(words) for _ in range(20))
        docs.append((k if k % 13 else None, ("ab" * 100 if k % 11 == 0 else text * (1 + (k % 7 == 0))) if k % 17 else None))
    df = spark.createDataFrame(docs + docs[:4], "doc_id long, text string")
    assert got(df, 40, 12, 3, (8, 2, 1)) == brute(df, 40)


def test_long_texts_come_in_stretches(spark, monkeypatch):
    monkeypatch.setattr(S, "BUFFER", 2000)
    rnd = random.Random(4)
    text = "".join(rnd.choice("abcd") for _ in range(7000))
    df = spark.createDataFrame([(1, text + text[1500:3500]), (2, "q" + text[5000:5600])], "doc_id long, text string").coalesce(1)
    batches = df.toArrow().to_batches()
    runs = [r for b in batches for _, data, row, at, bounds in S.cut(iter([b]), "text", 400) for r in zip(*S.anchor_runs(data, bounds[:, 0], bounds[:, 1])[:2], [int(at[0])] * 999)]
    assert sum(c for _, c, _ in runs) == 9000 - 399 + 601 - 399
    assert got(df) == brute(df, 400)


def test_documents_and_odd_rows(documents, odd, empty):
    assert got(documents) == brute(documents, 400)
    small = odd.where("doc_id is null or doc_id <> 5")
    assert got(small, 40, 12) == brute(small, 40)
    assert got(empty) == []


def test_texts_lose_their_repeats_and_keep_their_columns(odd):
    cut = S.remove_repeats(odd, 40, 12)
    assert cut.columns == odd.columns and cut.count() == odd.count()
    assert {r.text for r in cut.where("doc_id in (3, 4)").collect()} == {""}


def cut_words(texts, words):
    """The words that are left of each text, by brute force."""
    split = [(t or "").encode().split() for t in texts]
    counts = Counter(tuple(w[k : k + words]) for w in split for k in range(len(w) - words + 1))
    out = []
    for w in split:
        gone = [False] * len(w)
        for k in range(len(w) - words + 1):
            if counts[tuple(w[k : k + words])] > 1:
                gone[k : k + words] = [True] * words
        out.append([x for x, g in zip(w, gone) if not g])
    return out


@pytest.mark.parametrize("seed", [3, 4])
def test_repeated_words_against_brute_force(spark, seed):
    rnd = random.Random(seed)
    words = ["".join(rnd.choice("abcdeé") for _ in range(rnd.randint(1, 6))) for _ in range(40)]
    base = [rnd.choice(words) for _ in range(40)]
    docs = []
    for k in range(60):
        text = [rnd.choice(words) for _ in range(rnd.randint(0, 40))]
        if k % 2:
            at, n = rnd.randint(0, 20), rnd.randint(5, 20)
            text += base[at : at + n] + [rnd.choice(words) for _ in range(9)]
        docs.append((k if k % 13 else None, rnd.choice([" ", "\n", " \t"]).join(text) if k % 17 else None, k))
    docs.append((70, "no no " * 60, 1))
    df = spark.createDataFrame(docs + docs[:4], "doc_id long, text string, hf int")
    out = S.remove_repeated_words(df, 8, 3, 3, (32, 4, 1))
    assert out.columns == df.columns
    want = cut_words([r.text for r in df.collect()], 8)
    got_ = {}
    for r in out.collect():
        got_.setdefault((r.doc_id, r.hf), []).append((r.text or "").encode().split())
    for r, w in zip(df.collect(), want):
        assert w in got_[r.doc_id, r.hf]


def test_passages_of_over_50_words_go_whatever_their_length_in_bytes(spark):
    rnd = random.Random(8)
    lengths = [51, 53, 60, 75]

    def prose(n):
        return [rnd.choice("abcdefg") * rnd.randint(1, 3) + str(rnd.randint(0, 10**6)) for _ in range(n)]

    passages = [[w[:4] for w in prose(n)] for n in lengths]
    assert all(len(" ".join(p)) < 400 for p in passages)
    docs = [(10 * i + j, " ".join([*prose(30), *p, *prose(20)])) for i, p in enumerate(passages) for j in range(3)]
    clean = [(900 + k, " ".join(prose(90))) for k in range(10)]
    short = [(950 + k, " ".join([*prose(30), *passages[3][:40], *prose(30)])) for k in range(2)]
    df = spark.createDataFrame(docs + clean + short, "doc_id long, text string")
    left = {r.doc_id: r.text for r in S.remove_repeated_words(df).collect()}
    before = dict(docs + clean + short)
    assert all(left[k] == before[k] for k, _ in clean + short)
    assert all(len(left[k].split()) == 50 for k, _ in docs)
    assert all(len(left[k].encode()) < len(t.encode()) for k, t in docs)


def test_words_of_long_texts_and_of_odd_rows(spark, odd, empty, monkeypatch):
    monkeypatch.setattr(S, "BUFFER", 2000)
    rnd = random.Random(5)
    text = [str(rnd.randint(0, 10**5)) for _ in range(1500)]
    df = spark.createDataFrame([(1, " ".join(text + text[100:300])), (2, " ".join(["q", *text[700:760], "r"]))], "doc_id long, text string").coalesce(1)
    assert [r.text.split() for r in sorted(S.remove_repeated_words(df).collect())] == [[w.decode() for w in x] for x in cut_words([r.text for r in df.collect()], 49)]
    cut = S.remove_repeated_words(odd, 6, 2)
    assert cut.columns == odd.columns and cut.count() == odd.count()
    assert {r.text for r in cut.where("doc_id in (3, 4)").collect()} == {""}
    assert S.remove_repeated_words(empty).count() == 0
