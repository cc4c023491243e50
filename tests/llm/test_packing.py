import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from holdfast.llm import packing as P

PATH = public_tokenizers.path("word_bpe_49k.json")


def placed(counts, capacity):
    """The sequences' contents under the plan, and their number."""
    runs, bins = P.plan_runs(counts, capacity)
    seqs, ranks = {}, Counter()
    for r in runs:
        assert r.rank == ranks[r.length]
        ranks[r.length] += r.count
        for k in range(r.count):
            seqs.setdefault(r.bin + k // r.per_bin, []).append((r.offset + k % r.per_bin * r.length, r.length))
    assert ranks == Counter({n: c for n, c in counts.items() if c})
    assert set(seqs) == set(range(bins))
    for parts in seqs.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return bins


def fewest(items, capacity):
    best = len(items)

    def go(k, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if k == len(items):
            best = len(rooms)
            return
        for i in range(len(rooms)):
            if rooms[i] >= items[k]:
                go(k + 1, rooms[:i] + [rooms[i] - items[k]] + rooms[i + 1 :])
        go(k + 1, rooms + [capacity - items[k]])

    go(0, [])
    return best


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 20), min_size=1, max_size=9))
def test_plan_is_gapless_and_near_the_fewest(items):
    got = placed(Counter(items), 20)
    assert fewest(sorted(items, reverse=True), 20) <= got <= fewest(sorted(items, reverse=True), 20) + 1


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 20), min_size=1, max_size=8))
def test_fixed_bins_never_cost_a_sequence(items):
    rest, fixed = P.reduce_dominated(Counter(items), 20)
    left = [n for n, c in rest.items() for _ in range(c)]
    assert sum(t for _, t in fixed) + fewest(sorted(left, reverse=True), 20) == fewest(sorted(items, reverse=True), 20)


@pytest.mark.parametrize("items, bins", [([11, 8, 8, 4, 3, 3, 3], []), ([11, 6, 3, 3, 3], []), ([11, 6, 6, 3], [[11, 6, 3]]), ([11, 9, 3, 3, 3], [[11, 9]])])
def test_only_dominating_bins_are_fixed(items, bins):
    rest, fixed = P.reduce_dominated(Counter(items), 20)
    left = [n for n, c in rest.items() for _ in range(c)]
    assert sum(t for _, t in fixed) + fewest(sorted(left, reverse=True), 20) == fewest(sorted(items, reverse=True), 20)
    assert all(f in [x for x, _ in fixed] for f in bins)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([2, 3, 4, 5, 6, 7, 8, 9, 11, 12, 13]), min_size=4, max_size=9))
def test_fixed_bins_of_few_lengths_never_cost_a_sequence(items):
    test_fixed_bins_never_cost_a_sequence.hypothesis.inner_test(items)


def test_best_fit_equals_piece_by_piece():
    rnd = random.Random(5)
    for _ in range(40):
        items = sorted((rnd.randint(1, 50) for _ in range(200)), reverse=True)
        rooms = []
        for n in items:
            fit = [r for r in rooms if r >= n]
            if fit:
                rooms.remove(min(fit))
                rooms.append(min(fit) - n)
            else:
                rooms.append(50 - n)
        bins = 0
        for *_, bins in P.best_fit(Counter(items), 50):
            pass
        assert bins == len(rooms)


@pytest.mark.parametrize("text", ["", " ", "It's We'LL don't", "a<|endoftext|>b <|ENDOFTEXT|>", "A.B,, a'b' 12.5% naïve…» x́ \x1c", "word, word. WORD!! ###"])
def test_word_cache_gives_the_tokenizers_ids(text):
    assert P.word_ids(PATH).of(text.encode()) == np.array(Tokenizer.from_file(PATH).encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def check(rows, texts, capacity):
    tok = Tokenizer.from_file(PATH)
    pieces = Counter()
    for text in texts:
        ids = np.array([*tok.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        for k, s in enumerate(range(0, len(ids), capacity)):
            pieces[k, s, len(ids[s : s + capacity]), zlib.crc32(ids[s : s + capacity].tobytes())] += 1
    assert Counter((r.piece, r.start, r.length, r.ids_crc32) for r in rows) == pieces
    seqs = {}
    for r in rows:
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in seqs.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity


def test_documents_are_whole_and_gapless(documents):
    check(P.pack_documents(documents, PATH).collect(), [r.text for r in documents.select("text").collect()], 4096)


def test_odd_rows(odd, empty):
    rows = P.pack_documents(odd, PATH).collect()
    check(rows, [r.text for r in odd.collect()], 4096)
    assert Counter(r.doc_id for r in rows if r.piece == 0) == Counter(r.doc_id for r in odd.collect())
    assert P.pack_documents(empty, PATH).count() == 0
