import random
import re

import numpy as np
import pytest
import xxhash

from holdfast.llm import simhash as S
from holdfast.llm.components import components


def slow_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(words[k : k + 4]), seed=42) for k in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def slow_components(ids, fps, radius=4):
    root = list(range(len(ids)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i in range(len(ids)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                root[find(i)] = find(j)
    least = {}
    for k, d in enumerate(ids):
        if d is not None:
            least[find(k)] = min(d, least.get(find(k), d))
    return [least.get(find(k)) for k in range(len(ids))]


def compare(df):
    data = [(r.doc_id, slow_fingerprint(r.text)) for r in df.collect()]
    want = sorted(((d, f"{f:016x}", c) for (d, f), c in zip(data, slow_components(*zip(*data)))), key=repr)
    assert sorted((tuple(r) for r in S.dedup_simhash(df).collect()), key=repr) == want


def test_documents(documents):
    compare(documents)


def test_odd_rows(odd, empty):
    compare(odd)
    assert S.dedup_simhash(empty).count() == 0


@pytest.mark.parametrize("tile", [4, 2048])
def test_tiles_find_every_link(spark, tile):
    rnd = random.Random(tile)
    fps = [rnd.getrandbits(64) for _ in range(60)]
    for _ in range(200):  # groups of near copies, chains among them
        fps.append(rnd.choice(fps) ^ sum(1 << rnd.randrange(64) for _ in range(rnd.randint(0, 5))) & (1 << 64) - 1)
    ids = list(range(len(fps)))
    df = spark.createDataFrame([(i, int(np.uint64(f).view(np.int64))) for i, f in zip(ids, fps)], "doc_id long, fingerprint long")
    got = {r.doc_id: r.component_id for r in S.near_duplicates(df, 4, tile).collect()}
    assert [got[i] for i in ids] == slow_components(ids, fps)


def test_tiles_of_a_hot_bucket_pair_up_within_the_radius_only(spark):
    """One bucket of fingerprints that differ in their low half: every near pair meets in a tile pair, far tiles do not meet."""
    rnd = random.Random(11)
    fps = sorted({rnd.getrandbits(rnd.randint(1, 32)) for _ in range(1500)})
    ones = [f.bit_count() for f in fps]
    df = spark.createDataFrame([(0, 7, f, o) for f, o in zip(fps, ones)] + [(1, 9, 3, 2)], "choice int, part long, fingerprint long, ones int")
    large = spark.createDataFrame([(0, 7)], "choice int, part long")
    rows = S.tile_pairs(df, large, 4, 64).collect()
    assert [(r.one, r.two, r.mine) for r in rows if r.choice == 1] == [(0, 0, 0)]
    met, tiles = {}, {}
    for r in rows:
        if r.choice == 0:
            met.setdefault((r.one, r.two), set()).add(r.fingerprint)
            tiles.setdefault(r.mine, set()).add(r.fingerprint)
    assert sorted(f for t in tiles.values() for f in t) == fps and max(map(len, tiles.values())) < 160
    for one, two in met:
        assert min(f.bit_count() for f in tiles[two]) - max(f.bit_count() for f in tiles[one]) <= 4
    home = {f: t for t, fs in tiles.items() for f in fs}
    for a in fps[::7]:
        for b in fps:
            if (a ^ b).bit_count() <= 4:
                assert {a, b} <= met[min(home[a], home[b]), max(home[a], home[b])]
    assert len(met) < len(tiles) * (len(tiles) + 1) // 2


def test_all_numbers_of_blocks_lose_no_pair():
    rnd = random.Random(2)
    for blocks in (5, 6, 7, 8):
        edges = [64 * k // blocks for k in range(blocks + 1)]
        for _ in range(300):
            x = sum(1 << b for b in rnd.sample(range(64), 4))
            assert sum(x >> edges[k] & (1 << edges[k + 1] - edges[k]) - 1 == 0 for k in range(blocks)) >= blocks - 4


def test_components_of_a_chain_and_a_hub(spark):
    links = [(k, k + 1) for k in range(30)] + [(100, 100 + k) for k in range(1, 40)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(31)} | {100 + k: 100 for k in range(40)}


def test_one_of_each_group_stays(spark, odd):
    kept = S.keep_first_of_groups(odd)
    assert kept.columns == odd.columns
    groups = {slow_fingerprint(r.text) for r in odd.collect()}
    assert kept.count() == len(set(slow_components(list(range(len(groups))), list(groups))))
    assert {3, 5} <= {r.doc_id for r in kept.collect()}
