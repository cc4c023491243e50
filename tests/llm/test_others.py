"""Sharding, SentencePiece, quality rules, LM scoring, WARC, top-k search and the classifier."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from helpers import rows

from holdfast.llm import classifier, elias_fano, lm_scoring, quality_rules, sharding, topk, warc
from holdfast.llm import sentencepiece as pieces
from holdfast.llm.common import scratch

PIECES = public_tokenizers.path("piece_bpe_32k.model")


# Sharding


def test_store_versions_merge_and_expire(spark):
    store = sharding.ShardStore(spark, scratch(spark, "store"))
    assert store.latest() is None and store.compact() is None
    for k in range(5):
        store.append(spark.range(k * 100, k * 100 + 100).selectExpr("id", "repeat('x', 50) as s"), 20)
    assert store.latest().number == 5
    before = store.manifest().count()
    version = store.compact(1 << 20)
    assert version.number == 6 and store.manifest().count() < before
    assert rows(store.read().select("id")) == rows(spark.range(500))
    assert store.read(store.version(2)).count() == 200
    assert store.compact(1 << 20).number == 6
    assert store.expire() == before and store.read().count() == 500


def test_second_writer_of_a_version_fails(spark):
    store = sharding.ShardStore(spark, scratch(spark, "store"))
    version = store.append(spark.range(3))
    assert not store._commit(version.number, store.manifest(), version.schema)
    assert store.append(spark.range(2)).number == 2 and store.read().count() == 5


def test_a_merge_of_replaced_shards_is_refused(spark):
    store = sharding.ShardStore(spark, scratch(spark, "store"))
    for _ in range(4):
        version = store.append(spark.range(10))
    run = store.manifest().collect()
    store.compact()
    with pytest.raises(sharding.Conflict):
        store._merge(version, [run], 1 << 20)


def test_sharding_keeps_odd_rows(odd, empty):
    assert rows(sharding.shard_documents(odd)) == rows(odd)
    assert rows(sharding.shard_documents(empty)) == []


def test_tiers():
    assert [sharding.tier_of(x << 20) for x in (0, 1, 3, 4, 15, 16)] == [0, 1, 1, 2, 2, 3]


# SentencePiece


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


def ids(model, text):
    return np.frombuffer(model.encode(text), "<u4").tolist()


def test_pieces_equal_the_library(library, documents):
    model = pieces.load(PIECES)
    for r in documents.limit(60).collect():
        assert ids(model, r.text) == library.encode(r.text)
    rnd = random.Random(1)
    for _ in range(800):
        text = "".join(rnd.choice("ab ▁ \n éßthe·12.,😀漢字  s") for _ in range(rnd.randint(0, 60)))
        assert ids(model, text) == library.encode(text)
        assert model.decode(library.encode(text)).decode() == library.decode(library.encode(text))


def test_words_of_a_batch_are_searched_side_by_side(library, documents, monkeypatch):
    with open(PIECES, "rb") as f:
        model = pieces.PieceModel(f.read())
    rnd = random.Random(4)
    found = [" ".join("".join(rnd.choice("abctionthé.,") for _ in range(rnd.randint(1, 40))) for _ in range(300)) + "\nfirst of a line\n" for _ in range(5)]
    monkeypatch.setattr(pieces, "BLOCK", 5000)
    monkeypatch.setattr(pieces, "MOST_PAIRS", 3000)
    alone = []
    monkeypatch.setattr(pieces.PieceModel, "search", lambda self, text: alone.append(text) or iter(self.merged(text)))
    model.learn(found)
    assert [ids(model, x) for x in found] == [library.encode(x) for x in found]
    assert alone == []
    found = [r.text for r in documents.limit(40).collect()]
    model.learn(found)
    assert [ids(model, x) for x in found] == [library.encode(x) for x in found]


def test_words_that_cannot_be_searched_side_by_side(library):
    model = pieces.load(PIECES)
    words = ["▁the", "a\0b", "\0", "😀x", "▁" + "s" * 40, "漢字", "▁\x07"]
    for word, got in zip(words, model.search_all(words)):
        assert got == (model.encode_run(word) if set(word) <= model.ids.keys() else None)
    odd = ["", " ", "a  b", "\n\n", "▁ ▁a", "\0 \0a b", "😀 x😀 y", " a", "a ", "é\n\té  \n a"]
    model.learn(odd)
    assert [ids(model, x) for x in odd] == [library.encode(x) for x in odd]


def test_codes():
    rnd, codes, held = random.Random(5), pieces.Codes(2), {}
    for _ in range(40):
        new = sorted({rnd.randrange(1 << rnd.choice((4, 40))) for _ in range(rnd.randint(0, 60))} - held.keys())
        held |= {k: rnd.randrange(1 << 30) for k in new}
        codes.put(np.array(new, np.int64), np.array([held[k] for k in new], np.int32))
        ask = list(range(20)) + list(held) + [rnd.randrange(1 << 40) for _ in range(50)]
        assert codes.get(np.array(ask, np.int64)).tolist() == [held.get(k, -1) for k in ask]


def test_ids_are_final_before_the_text_ends(library):
    text = "▁" + "internationalisation" * 400
    seen = []

    class Watched(str):
        def __getitem__(self, k):
            seen.append(k.stop if isinstance(k, slice) else k)
            return str.__getitem__(self, k)

    stream = pieces.load(PIECES).search(Watched(text))
    first = next(stream)
    assert max(seen) < 200
    assert [pieces.load(PIECES).ids[p] for p in (first, *stream)] == library.encode(text[1:])


def test_unigram_models_take_the_best_score():
    from sentencepiece import sentencepiece_model_pb2 as pb

    proto = pb.ModelProto()
    proto.trainer_spec.model_type = 1
    proto.trainer_spec.byte_fallback = False
    proto.normalizer_spec.name = "identity"
    proto.normalizer_spec.add_dummy_prefix = True
    proto.normalizer_spec.remove_extra_whitespaces = False
    for piece, score, kind in [("<unk>", 0, 2), ("<s>", 0, 3), ("</s>", 0, 3), ("▁", -2, 1), ("a", -2, 1), ("b", -2.5, 1), ("ab", -3, 1), ("▁a", -3.2, 1), ("aba", -3.9, 1), ("bab", -4, 1), ("▁ab", -5.5, 1)]:
        proto.pieces.add(piece=piece, score=score, type=kind)
    data = proto.SerializeToString()
    ours, theirs = pieces.PieceModel(data), sentencepiece.SentencePieceProcessor(model_proto=data)
    rnd = random.Random(3)
    for _ in range(200):
        text = "".join(rnd.choice("ab ab") for _ in range(rnd.randint(1, 90)))
        assert ids(ours, text) == theirs.encode(text)


def test_sentencepiece_round_trip_of_odd_rows(odd, empty):
    got = sorted((r.doc_id or 0, r.decoded_bytes, r.decoded_sha256) for r in pieces.round_trip(odd, PIECES).collect())
    want = sorted((r.doc_id or 0, len((r.text or "").encode()), hashlib.sha256((r.text or "").encode()).hexdigest()) for r in odd.collect())
    assert got == want
    assert pieces.round_trip(empty, PIECES).count() == 0


# Quality rules


def slow_statistics(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[k : k + 8]) for k in range(len(words) - 7)]
    counts = Counter(windows)
    covered = {k + j for k, w in enumerate(windows) if counts[w] > 1 for j in range(8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_base_statistics(documents, odd, empty):
    for df in (documents, odd):
        got = sorted((tuple(r)[:7] for r in quality_rules.quality_rules(df).collect()), key=repr)
        want = []
        for r in df.collect():
            s = slow_statistics(r.text)
            want.append((r.doc_id, *s, s[0] < 20 or 100 * s[4] > 30 * s[0]))
        assert got == sorted(want, key=repr)
    assert quality_rules.quality_rules(empty).count() == 0


def test_equal_hashes_of_unequal_windows_are_told_apart(monkeypatch):
    ids_ = np.array([1, 2, 3, 1, 2, 4, 1, 2, 3], np.int64)
    ends = np.array([9])
    assert quality_rules.repeated_words(ids_, np.array([0]), ends, 3).tolist() == [6]
    monkeypatch.setattr(quality_rules, "MIX", np.uint64(0))  # every window has one hash
    assert quality_rules.repeated_words(ids_, np.array([0]), ends, 3).tolist() == [6]


def test_concentration_step_is_the_covariance_of_the_nearest(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(0, 0.3, (600, quality_rules.P))
    x[:60] += 4
    df = spark.createDataFrame([("en", "s", *map(float, r)) for r in x], "lang string, source string, " + ", ".join(f"x{i} double" for i in range(quality_rules.P)))
    found = {r.g: r for r in quality_rules.estimates(df).collect()}
    own = next(r for g, r in found.items() if "source" in g)
    assert own.rows == 600
    clean = x[60:]
    assert np.allclose([own[f"m{i}"] for i in range(quality_rules.P)], clean.mean(axis=0), atol=0.06)
    precision = np.zeros((quality_rules.P,) * 2)
    for i, j in quality_rules.PAIRS:
        precision[i, j] = precision[j, i] = own[f"p{i}{j}"]
    cov = np.linalg.inv(precision) - np.diag(quality_rules.VARIANCE_FLOOR)
    assert np.allclose(np.diag(cov), clean.var(axis=0), rtol=0.45)


def test_outliers_go_and_clean_texts_stay(spark):
    rnd = random.Random(7)

    def prose():
        return ". ".join(" ".join("".join(rnd.choice("etaoinshrdlu") for _ in range(rnd.randint(2, 9))) for _ in range(12)).capitalize() for _ in range(5))

    texts = [prose() for _ in range(200)] + ["# ".join(prose().split()) for _ in range(10)] + [prose().upper() for _ in range(10)]
    df = spark.createDataFrame([(k, t, "en", "s") for k, t in enumerate(texts)], "doc_id long, text string, lang string, source string")
    kept = {r.doc_id for r in quality_rules.quality_rules(df).where("kept").collect()}
    assert kept == set(range(200))
    assert {r.doc_id for r in quality_rules.apply_rules(df).collect()} == kept


@pytest.mark.parametrize("junk", [0.34, 0.45])
def test_junk_of_a_third_of_a_group_goes(spark, junk):
    rng = np.random.default_rng(3)
    n, bad = 1000, int(1000 * junk)
    stats = []
    for k in range(n):
        words, chars = 200, int(1000 + rng.normal(0, 60))
        stats.append((k, "en", "s", words, chars, int(words * rng.normal(0.9, 0.01) ** 2) if k < bad else int(rng.integers(0, 5)), 0, 0, 20, int(chars * rng.uniform(0.01, 0.03))))
    df = spark.createDataFrame(stats, "doc_id long, lang string, source string, " + ", ".join(f"{c} long" for c in quality_rules.STATISTICS))
    kept = {r.doc_id for r in quality_rules.judge(df).where("kept").collect()}
    assert not kept & set(range(bad))
    assert len(kept) >= 0.99 * (n - bad)


ORDINARY = {"n_words": 1000, "word_chars": 5000, "n_symbols": 2, "n_dup_lines": 0, "n_repeat_words": 0, "n_lines": 200, "n_capitals": 100}


@pytest.mark.parametrize("outlier", [{"word_chars": 14000, "n_capitals": 280}, {"n_symbols": 300}, {"n_dup_lines": 190}, {"n_repeat_words": 290}, {"n_capitals": 2500}])
def test_each_statistic_alone_can_reject(spark, outlier):
    rng = np.random.default_rng(4)
    rows_ = [ORDINARY | {"word_chars": int(5000 + rng.normal(0, 300)), "n_symbols": int(rng.integers(0, 5)), "n_capitals": int(100 + rng.normal(0, 10))} for _ in range(300)]
    df = spark.createDataFrame([(k, "en", "s", *(r[c] for c in quality_rules.STATISTICS)) for k, r in enumerate([*rows_, ORDINARY | outlier])], "doc_id long, lang string, source string, " + ", ".join(f"{c} long" for c in quality_rules.STATISTICS))
    kept = {r.doc_id for r in quality_rules.judge(df).where("kept").collect()}
    assert 300 not in kept
    assert len(kept) >= 297


def test_chi_square():
    assert quality_rules.chi_square_quantile(0.95, 2) == pytest.approx(5.991, abs=1e-3)
    assert quality_rules.chi_square_quantile(0.99, 5) == pytest.approx(15.086, abs=1e-3)


# LM scoring


@pytest.mark.parametrize("n, top", [(1, 5), (1000, 1000), (3000, 2**63), (500, 40)])
def test_elias_fano(n, top):
    rng = np.random.default_rng(n)
    values = np.sort(rng.integers(0, top, n, dtype=np.uint64))
    seq = elias_fano.EliasFano(*elias_fano.EliasFano.build(values).values())
    assert (seq.get(np.arange(n)) == values).all()
    asked = np.r_[values, rng.integers(0, top, 300, dtype=np.uint64), np.array([0, top], np.uint64)]
    at = np.searchsorted(values, asked)
    hit = (at < n) & (values[np.minimum(at, n - 1)] == asked)
    assert (seq.find(asked) == np.where(hit, at, -1)).all()


@pytest.mark.parametrize("bits", [0, 1, 7, 31, 32, 33, 63, 64])
def test_low_bits_of_any_width(bits):
    values = np.random.default_rng(bits).integers(0, 2**64, 200, dtype=np.uint64)
    low = elias_fano._low_bits(values, bits)
    stream = sum(int(x) << (64 * k) for k, x in enumerate(low.tolist()))
    assert all(stream >> (k * bits) & ((1 << bits) - 1) == x & ((1 << bits) - 1) for k, x in enumerate(values.tolist()))
    assert len(low) >= (200 * bits + 63) // 64 + 2


def test_select_in_word_and_groups():
    rnd = random.Random(8)
    for word in [1, 1 << 63, 2**64 - 1, *(rnd.getrandbits(64) & rnd.getrandbits(64) | 2 for _ in range(50))]:
        at = [k for k in range(64) if word >> k & 1]
        assert elias_fano.select_in_word(np.full(len(at), word, np.uint64), np.arange(len(at))).tolist() == at
    for copies in (1, 5, 63, 64, 65, 200):  # groups that end in, at and beyond a word's end
        values = np.sort(np.array([x for k in range(40) for x in [k * 97] * (copies if k % 3 == 0 else k % 5)], np.uint64))
        seq = elias_fano.EliasFano(*elias_fano.EliasFano.build(values).values())
        asked = np.arange(0, 40 * 97 + 3, dtype=np.uint64)
        at = np.searchsorted(values, asked)
        hit = (at < len(values)) & (values[np.minimum(at, len(values) - 1)] == asked)
        assert (seq.find(asked) == np.where(hit, at, -1)).all()
        start, stop = seq._group(np.arange(seq.top + 1))
        high = (values >> np.uint64(seq.bits)).astype(np.int64)
        assert (start == np.searchsorted(high, np.arange(seq.top + 1))).all() and (stop == np.searchsorted(high, np.arange(seq.top + 1), side="right")).all()


def test_elias_fano_with_one_long_group():
    values = np.r_[np.arange(5000), [10**12]].astype(np.uint64)
    seq = elias_fano.EliasFano(*elias_fano.EliasFano.build(values).values())
    assert (seq.find(values) == np.arange(5001)).all() and seq.find(np.array([5000, 10**12 + 1])).tolist() == [-1, -1]


def slow_scores(data):
    tokens = [[*(t or "").encode().lower().split(), b"\n"] for _, t in data]
    out = [d is not None and zlib.crc32(str(d).encode()) % 7 == 2 for d, _ in data]
    uni, pairs, triples, followed = Counter(), Counter(), Counter(), Counter()
    for w, held in zip(tokens, out):
        if not held:
            uni.update(w)
            pairs.update(zip([b"\n", *w], w))
            triples.update(zip([b"\n", *w], w, w[1:]))
            followed.update(zip([b"\n", *w[:-1]], w[:-1]))
    n, v, mass = sum(uni.values()), len(uni), lm_scoring.MASS

    def two(a, x):
        return (pairs[a, x] + mass * (uni[x] + 1) / (n + v + 1)) / (uni[a] + mass)

    def three(a, b, x):
        return (triples[a, b, x] + mass * two(b, x)) / (followed[a, b] + mass)

    for (d, _), w, held in zip(data, tokens, out):
        base = sum(math.log10((uni[x] + 1) / (n + 1 * (v + 1))) for x in w)
        full = math.log10(two(b"\n", w[0])) + sum(math.log10(three(a, b, x)) for a, b, x in zip([b"\n", *w], w, w[1:]))
        yield d, held, len(w), sum(x in uni for x in w), n, base, full


@pytest.mark.parametrize("shards", [False, True])
def test_lm_scores(documents, odd, empty, monkeypatch, shards):
    if shards:
        for name, x in (("SHARD_WORDS", 500), ("SHARD_TOKENS", 3000), ("HELD_ROWS", 2000), ("HELD_WORDS", 700)):
            monkeypatch.setattr(lm_scoring, name, x)
    for df in (documents, odd):
        got = sorted((tuple(r) for r in lm_scoring.score_documents(df).collect()), key=repr)
        want = sorted(slow_scores([(r.doc_id, r.text) for r in df.collect()]), key=repr)
        assert [r[:5] for r in got] == [r[:5] for r in want]
        for a, b in zip(sorted(got, key=lambda r: (repr(r[0]), r[5])), sorted(want, key=lambda r: (repr(r[0]), r[5]))):
            assert a[5] == pytest.approx(b[5], abs=1e-6) and a[6] == pytest.approx(b[6], abs=4e-4 * a[2] + 1e-9)
    assert lm_scoring.score_documents(empty).count() == 0


def test_rows_sort_alike_at_any_size_of_vocabulary():
    rng = np.random.default_rng(6)
    u, v, w = rng.integers(0, 9, (3, 500))
    want = sorted(Counter(zip(u.tolist(), v.tolist(), w.tolist())).items())
    for top in (9, 2**21, 2**24, 2**30, 2**40):
        got = lm_scoring.counted(u, v, w, top)
        assert [((a, b, c), n) for a, b, c, n in zip(*(x.tolist() for x in got))] == want
        back = lm_scoring._unpack(lm_scoring._pack(*got, top), top)
        assert all((a == b).all() for a, b in zip(got, back))


def test_a_trie_finds_the_numbers_of_its_rows_and_no_others(spark):
    """Numbers beyond 32 bits, contexts without trigrams, and rows that the level lacks."""
    rng = np.random.default_rng(7)
    far = 2**40
    u, v, w = (rng.integers(0, 6, 400) * (far // 8) for _ in range(3))
    w = np.where(v == 5 * (far // 8), far, w)  # such rows end a text

    class Known:
        total, size = 400, far
        folder = ""

        def of(self, number, field):
            return np.full(len(number), 7.0)

    rows_ = lm_scoring.counted(u, v, w, far)
    level = lm_scoring.build_level(*rows_, Known())
    pairs, triples, followed = Counter(), Counter(), Counter()
    for a, b, c, n in zip(*(x.tolist() for x in rows_)):
        pairs[a, b] += n
        if c < far:
            triples[a, b, c] += n
            followed[a, b] += n
    asked = np.array(sorted({(a * (far // 8), b * (far // 8), c) for a in range(8) for b in range(8) for c in (*(np.arange(8) * (far // 8)).tolist(), 3, -1, far)}))
    p, share, weight = lm_scoring.find_rows(level, *asked.T, far)
    mass = lm_scoring.MASS
    for (a, b, c), x, y, z in zip(asked.tolist(), p, share, weight):
        assert math.isnan(x) == ((a, b) not in pairs)
        assert z == pytest.approx(mass / (followed[a, b] + mass), rel=1e-3)
        assert y == pytest.approx(triples[a, b, c] / (followed[a, b] + mass), rel=1e-3)


def test_tasks_sort_no_rows_twice(monkeypatch):
    """Of 22 bits a word and more, rows did not fit one key: a task then sorted them by two keys."""
    rng, size = np.random.default_rng(9), 2**22
    numbers = [np.sort(rng.choice(size, 50, replace=False)) for _ in range(3)]
    end = int(numbers[0][0])
    numbers = [np.r_[end, np.setdiff1d(x, end)[::-1]] for x in numbers]
    lengths = [rng.integers(1, 9, 40) for _ in numbers]
    index = [rng.integers(0, len(x), n.sum()) for x, n in zip(numbers, lengths)]
    want = lm_scoring.counted(*lm_scoring.rows_of(np.concatenate([x[k] for x, k in zip(numbers, index)]), np.concatenate(lengths), end, size), size)
    monkeypatch.setattr(np, "lexsort", None)
    got = lm_scoring.counted_ranks(numbers, index, lengths, end, size)
    assert all((a == b).all() for a, b in zip(got, want))


def test_only_so_many_files_stay_open(tmp_path, monkeypatch):
    monkeypatch.setattr(elias_fano, "OPEN", 3)
    for k in range(6):
        elias_fano.save(f"file://{tmp_path}/{k}.level", {"x": np.array([k])})
        elias_fano.save(f"file://{tmp_path}/{k}.level", {"x": np.array([k])})  # a second attempt
    assert [elias_fano.load(f"file://{tmp_path}/{k}.level")["x"][0] for k in (*range(6), 0)] == [*range(6), 0]
    assert elias_fano.load(f"file://{tmp_path}/none.level") is None
    assert len(elias_fano._open) <= 3 and len(list(tmp_path.iterdir())) == 6
    monkeypatch.setattr(elias_fano, "_mounted", lambda fs: False)  # a store whose files cannot be mapped
    monkeypatch.setattr(elias_fano, "READ_BYTES", 50)
    elias_fano._open.clear()
    assert [elias_fano.load(f"file://{tmp_path}/{k}.level")["x"][0] for k in range(6)] == list(range(6))
    assert len(elias_fano._open) == 1
    elias_fano._open.clear()


# WARC


def page_rows(spark):
    big, small = "<p>é</p>" * 200, "<p>small</p>"
    data = [(1, "http://a/1", big), (2, "http://a/2 x\r\ny", big), (3, None, small), (4, "http://a/4", small), (5, "u", None), (6, "u", ""), (None, "n", big), (7, "u", "x" * 3_000_000), (7, "u", "x" * 3_000_000)]
    return spark.createDataFrame([(*r, "extra") for r in data], "page_id long, url string, html string, payload string")


def test_warc_round_trip(spark):
    pages = page_rows(spark)
    got = rows(warc.round_trip(pages))
    want = []
    for r in pages.collect():
        data = (r.html or "").encode()
        first = {1: 2, None: 2}.get(r.page_id)
        want.append((r.page_id, len(data), hashlib.sha1(data).hexdigest(), "revisit" if first else "response", first))
    assert got == sorted(want, key=repr)
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_chunks_join_to_the_payload(spark):
    archives = warc.write_archives(page_rows(spark), scratch(spark, "warc"), 4000)
    assert archives.count() >= 2 and archives.agg({"records": "sum"}).first()[0] == 9
    chunks = warc.read_archives(archives, 1 << 10).where("page_id = 2").orderBy("chunk").collect()
    assert [c.chunk for c in chunks] == [0, 1] and [c.last for c in chunks] == [False, True]
    assert b"".join(bytes(c.data) for c in chunks).decode() == "<p>é</p>" * 200
    assert chunks[0].digest_so_far == hashlib.sha1(bytes(chunks[0].data)).hexdigest()


def test_payloads_are_written_in_chunks(spark):
    chunks = warc.payload_chunks(warc.decide(page_rows(spark)), 1 << 20)
    big = chunks.where("page_id = 7").collect()
    assert sorted((r.chunk, r.last, len(r.data)) for r in big) == sorted(2 * [(0, False, 1 << 20), (1, False, 1 << 20), (2, True, 3_000_000 - (2 << 20))])
    assert [(r.chunk, r.last, r.data) for r in chunks.where("page_id = 1").collect()] == [(0, True, None)]
    assert [(r.chunk, r.last, bytes(r.data)) for r in chunks.where("page_id in (5, 6)").collect()] == 2 * [(0, True, b"")]
    pages = page_rows(spark)
    archives = warc.write_archives(pages, scratch(spark, "warc"), 4000, 700)
    whole = warc.read_archives(archives, 999).where("last and record_type = 'response'")
    assert {(r.page_id, r.bytes_so_far, r.digest_so_far) for r in whole.collect()} == {(r.page_id, len((r.html or "").encode()), hashlib.sha1((r.html or "").encode()).hexdigest()) for r in pages.where("page_id is not null and page_id <> 1").collect()}


def test_a_damaged_archive_is_noticed():
    import io

    data = b"hello world"
    record = warc.record_head(1, "u", hashlib.sha1(data).hexdigest(), len(data), None) + b"hello WORLD\r\n\r\n"
    with pytest.raises(ValueError):
        list(warc.read_records(io.BytesIO(record)))
    with pytest.raises(ValueError):
        list(warc.read_records(io.BytesIO(record[:-9])))


# Top-k search


def slow_top(data, k, step):
    whole = {}
    for i, v in data:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v):
            q = [math.floor(64 * x) for x in v]
            whole[i] = min(q, whole.get(i, q))
    for i in whole:
        if i % step == 0:
            score = sorted((-sum(a * b for a, b in zip(whole[i], v)), j) for j, v in whole.items() if j != i and len(v) == len(whole[i]))
            yield from ((i, n + 1, j, -s) for n, (s, j) in enumerate(score[:k]))


@pytest.mark.parametrize("block, query_block", [(4096, 1024), (16, 3)])
def test_top_k_against_brute_force(spark, block, query_block):
    rng = np.random.default_rng(block)
    data = [(k, rng.normal(0, 0.3, 6).tolist()) for k in range(300)]
    data += [(1000 + k, data[0][1]) for k in range(60)]  # one vector many times
    data += [(5, data[5][1]), (None, data[1][1]), (2000, None), (2020, [0.1, None]), (2040, [float("nan")] * 6), (2060, [float("inf")] * 6), (2080, [0.5, 0.25]), (2081, [0.5, 0.5]), (2100, [])]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>")
    data = [(r.vec_id, r.embedding) for r in df.collect()]
    got = sorted(tuple(r) for r in topk.top_k(df, 20, 20, block, query_block).collect())
    assert got == sorted(slow_top(data, 20, 20))
    assert topk.top_k(df.limit(0)).count() == 0


@pytest.mark.parametrize("block, query_block", [(4096, 1024), (16, 3)])
def test_top_k_keeps_large_components_and_repeated_ids(spark, block, query_block):
    rng = np.random.default_rng(block)
    data = [(k, rng.normal(0, 0.3, 6).tolist()) for k in range(200)]
    data += [(k, rng.normal(0, 0.3, 6).tolist()) for k in (0, 0, 3, 3, 20, 41)]  # other vectors under the same ids
    data += [(7, data[7][1])] * 30 + [(40, data[40][1])] * 2 + [(300 + k, data[7][1]) for k in range(50)]
    data += [(400 + k, (rng.normal(0, 1, 6) * 10.0 ** rng.integers(0, 7, 6)).tolist()) for k in range(60)] + [(500, [262144.0] + [0.0] * 5), (501, [-262144.0, 1.5] + [0.1] * 4)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>")
    whole = [(r.vec_id, [math.floor(64 * x) for x in r.embedding]) for r in df.collect()]
    want = []
    for i in {i for i, _ in whole if i % 20 == 0}:
        score = sorted((-sum(a * b for a, b in zip(q, v)), j) for own, q in whole if own == i for j, v in whole if j != i)
        want += [(i, n + 1, j, -s) for n, (s, j) in enumerate(score[:20])]
    assert sorted(tuple(r) for r in topk.top_k(df, 20, 20, block, query_block, equal_rows=True).collect()) == sorted(want)


def test_top_k_of_long_vectors_clashing_columns_and_negative_ids(spark):
    rng = np.random.default_rng(9)
    data = [(20 * k - 400, rng.normal(0, 1, 3000).tolist(), k, "x", 1.0, k) for k in range(40)] + [(7, (rng.normal(0, 1, 3000) * 1e6).tolist(), 0, "y", 2.0, 1), (9, (rng.normal(0, 1, 3000) * 1e12).tolist(), 0, "y", 2.0, 1), (11, None, 0, "z", 0.0, 2)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>, block int, q string, rank double, dim int")
    got = sorted(tuple(r) for r in topk.top_k(df, 5, 20, 16, 8).collect())
    assert got == sorted(slow_top([(r.vec_id, r.embedding) for r in df.collect()], 5, 20))


def test_exact_vectors_are_read_in_the_order_of_their_bounds(tmp_path, monkeypatch):
    """Of many vectors only a few are read exactly, and their files hold what was put in."""
    rng = np.random.default_rng(10)
    data = rng.integers(-300, 300, (2000, 16)).astype(np.int32)
    file = topk.VectorFile(f"file://{tmp_path}", 0, 0, 16, False, 2000)
    file.write(np.arange(2000), data)
    ids, middle, half, _ = file.scan()
    assert (np.abs(middle - data) <= half + 1e-9).all() and (file.rows(np.array([5, 1999])) == data[[5, 1999]]).all()
    read = []
    monkeypatch.setattr(topk.VectorFile, "rows", lambda self, at, rows=topk.VectorFile.rows: read.extend(at.tolist()) or rows(self, at))
    search = topk.Search(np.array([-1]), rng.integers(-300, 300, (1, 16)), 5)
    search.scan(file)
    got = search.rows().column("vec_id").to_pylist()
    order = np.lexsort((np.arange(2000), -(data.astype(np.int64) @ search.data[0])))
    assert got == order[:5].tolist() and len(read) <= topk.STRIDE


def test_top_k_of_extreme_components(spark):
    data = [(0, [1.0, 0.0]), (1, [1e15, 3.0]), (2, [-3e38, 0.0]), (3, [2.0, 1e30])]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    got = [tuple(r)[1:] for r in topk.top_k(df, 2).collect()]
    assert sorted(got) == [(1, 1, 64 * 64 * 10**15), (2, 3, 2 * 64 * 64)]
    with pytest.raises(Exception, match="exceeds 64 bits"):
        topk.top_k(df.union(spark.createDataFrame([(4, [3e38, 0.0])], df.schema)), 2).collect()


# Classifier


def labelled(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet")


def test_held_out_accuracy(spark):
    docs, labels = labelled(spark)
    got = classifier.classify(docs, labels).where("held_out").join(labels, "doc_id").collect()
    assert len(got) > 60
    assert sum(r.predicted == r.quality for r in got) / len(got) > 0.97
    assert all((r.score >= 0.7) == bool(r.predicted) for r in got)


def test_groups_of_unlabelled_rows_agree_with_one(spark):
    """The mean of many groups' models scores the held-out rows as well as one group's."""
    docs, labels = labelled(spark)
    one, many = classifier.fit(docs, labels), classifier.fit(docs, labels, 150)
    assert np.allclose(one.centre, many.centre) and np.allclose(one.scale, many.scale)
    assert abs(one.prior - many.prior) < 0.1
    truth = {r.doc_id: r.quality for r in labels.collect()}
    for model in (one, many):
        got = classifier.score_documents(docs, model).where("held_out").collect()
        known = [(r.predicted, truth[r.doc_id]) for r in got if r.doc_id in truth]
        assert sum(a == b for a, b in known) / len(known) > 0.95


def test_fit_against_brute_force(spark):
    """Which rows the fit learns from, their mean and spread, and the risk's minimiser, on a small table."""
    rnd = random.Random(12)
    data = [(k, " ".join(rnd.choice(["alpha", "beta!", "GAMMA", "x1"]) for _ in range(rnd.randint(0, 30)))) for k in range(120)]
    data += [data[3], data[3], (None, "alpha"), (7, "another text of seven")]
    docs = spark.createDataFrame([(*r, "extra") for r in data], "doc_id long, text string, x string")
    marks = [(k, k % 3 % 2) for k in range(0, 90)] + [(3, 0), (None, 1)]
    labels = spark.createDataFrame(marks, "doc_id long, quality int")
    known = {}
    for k, q in marks:
        known[k] = min(q, known.get(k, q))
    free = [(k, t) for k, t in sorted(set(data), key=repr) if k is not None and zlib.crc32(str(k).encode()) % 4 != 2]
    pos, unl = (classifier.features([t.encode() for k, t in sorted(free) if known.get(k) == q]) for q in (1, None))
    model = classifier.fit(docs, labels)
    assert np.allclose(model.centre, unl.mean(axis=0), atol=1e-6) and np.allclose(model.scale, unl.std(axis=0) + 1e-3, atol=1e-5)
    want = classifier.fit_arrays(pos, unl, model.centre, model.scale)
    assert abs(model.prior - want.prior) < 0.2 and np.corrcoef(model.weights, want.weights)[0, 1] > 0.9
    got = classifier.classify(docs, labels).collect()
    assert len(got) == len(data)
    assert len({r.score for r in got if r.doc_id == 3}) == 1  # repeated rows score alike
    texts_ = {(k, t) for k, t in data}
    want_score = {(k, t): float(model.score(classifier.features([t.encode()]))[0]) for k, t in texts_}
    assert sorted((str(r.doc_id), round(r.score, 4)) for r in got) == sorted((str(k), round(want_score[k, t], 4)) for k, t in data)


def test_risk_is_the_non_negative_one():
    """The step directions are those of the risk in the docstring, by finite differences."""
    rng = np.random.default_rng(3)
    pos, unl = rng.normal(0.4, 1, (40, 3)), rng.normal(0, 1, (90, 3))
    seen = []

    def watch(gradient, width, steps, **_):
        for _ in range(4):
            theta = rng.normal(0, 1.5, width + 1)
            seen.append((theta, np.r_[gradient(theta[:-1], theta[-1])]))
        return np.zeros(width), 0.0

    old, classifier._descend = classifier._descend, watch
    prior, classifier.class_prior = classifier.class_prior, lambda *_: 0.6
    try:
        classifier.fit_arrays(pos, unl, np.zeros(3), np.ones(3))
    finally:
        classifier._descend, classifier.class_prior = old, prior
    p, u = np.clip(pos, -4, 4), np.clip(unl, -4, 4)

    def parts(t):
        zp, zu = p @ t[:-1] + t[-1], u @ t[:-1] + t[-1]
        return 0.6 * np.logaddexp(0, -zp).mean(), np.logaddexp(0, zu).mean() - 0.6 * np.logaddexp(0, zp).mean()

    for theta, got in seen:
        def goal(t):
            plus, minus = parts(t)
            return plus + minus if parts(theta)[1] >= 0 else -minus

        want = [(goal(theta + e) - goal(theta - e)) / 2e-6 for e in 1e-6 * np.eye(4)]
        assert np.allclose(got, want, atol=1e-5)


def test_class_prior_is_close():
    rng = np.random.default_rng(0)
    pos, neg = rng.normal(1, 0.5, (4000, 5)), rng.normal(-1, 0.5, (4000, 5))
    unlabelled = np.r_[pos[:2100], neg[:900]]
    rng.shuffle(unlabelled)
    assert classifier.class_prior(pos[2100:], unlabelled) == pytest.approx(0.7, abs=0.05)
    model = classifier.fit_arrays(pos[2100:], unlabelled, unlabelled.mean(axis=0), unlabelled.std(axis=0))
    assert (model.score(pos) > 0.5).mean() > 0.98 and (model.score(neg) < 0.5).mean() > 0.98


def test_classifier_on_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(3, 1), (4, 1), (4, 0), (None, 1)], "doc_id long, quality int")
    got = classifier.classify(odd, labels).collect()
    assert len(got) == odd.count() and all(0 <= r.score <= 1 for r in got)
    assert {r.score for r in classifier.classify(odd, labels.limit(0)).collect()} == {0.5}
    assert classifier.classify(empty, labels).count() == 0
    assert classifier.keep_good(odd, labels).columns == odd.columns
