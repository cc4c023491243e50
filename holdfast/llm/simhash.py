"""SimHash near-duplicates by tiled exact comparison.

A fingerprint's bit is 1 if it is set in over half the XXH64 values (seed 42)
of a text's word shingles. Two fingerprints that differ in at most `radius` of
64 bits agree wholly in `blocks - radius` of any `blocks` parts of it, so
fingerprints are compared only within the buckets that share such parts; this
loses no link. Within a bucket they are ordered by the number of bits set and cut
into tiles; numpy's exclusive-or and bit counts compare two tiles exactly, and a
pair of tiles whose bit counts lie further apart than the radius is skipped.

Buckets beyond a tile are dealt out by pairs of tiles, each pair a group of its
own, so a large group of near copies is spread over tasks; a pair that bit counts
rule out is not dealt out at all. A fingerprint's tile follows from the counts of
its bucket by bits set, at most 65 a bucket, so nothing sorts a bucket. Equal
fingerprints are compared once. A pair of tiles yields a forest of links, never all
pairs.

Edge cases: a null or wordless text has fingerprint zero and is linked like any
other; fewer words than a shingle make one shingle; equal rows share a
fingerprint; null ids take no part in the smallest id of a component (which is
null if it has no other); further columns are not read; an empty table gives no
rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import materialise, partitions, release, row_key, slices, texts
from .components import components, local_roots

WORDS = 4
SEED = 42
RADIUS = 4
#: Fingerprints in a tile.
TILE = 2048


def fingerprint(text: bytes, words: int = WORDS, hash64=partial(xxhash.xxh64_intdigest, seed=SEED)) -> int:
    found = text.lower().split()
    if not found:
        return 0
    if len(found) <= words:
        return hash64(b" ".join(found))
    h = np.fromiter(map(hash64, map(b" ".join, zip(*(found[k:] for k in range(words))))), np.uint64, len(found) - words + 1)
    bits = np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return int.from_bytes(np.packbits(2 * bits.sum(axis=0, dtype=np.int64) > len(h), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), words: int = WORDS) -> DataFrame:
    """The columns in keep, and the text's fingerprint as a signed long."""

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = np.array([fingerprint(x, words) for x in texts(batch.column("text"))], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(found.view(np.int64))], names=[*keep, "fingerprint"])

    df = docs.select(*keep, F.col("text").cast("string").alias("text"))
    return df.mapInArrow(mark, T.StructType([*df.select(*keep).schema.fields, T.StructField("fingerprint", T.LongType())]))


def block_count(n: int, radius: int = RADIUS, tile: int = TILE) -> int:
    """The fewest parts with which n evenly spread fingerprints fill buckets of a tile at most."""
    for blocks in range(radius + 1, 2 * radius + 1):
        if n >> (64 * (blocks - radius) // blocks) <= tile:
            return blocks
    return 2 * radius


def buckets(fp: Column, blocks: int, radius: int = RADIUS) -> Column:
    """For each choice of blocks - radius parts, a hash of the choice and of the fingerprint's bits there."""
    edges = [64 * k // blocks for k in range(blocks + 1)]
    masks = [sum(((1 << edges[k + 1]) - (1 << edges[k])) for k in chosen) for chosen in combinations(range(blocks), blocks - radius)]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    return F.array(*(F.struct(F.lit(k).alias("choice"), fp.bitwiseAND(F.lit(m)).alias("part")) for k, m in enumerate(signed)))


def compare(fp: np.ndarray, first: np.ndarray, second: np.ndarray, radius: int, tile: int = 256) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of fp at `radius` or fewer differing bits, one index of first and one of second.

    Both are ascending by the number of bits set; tiles of them whose numbers
    differ beyond the radius are skipped.
    """
    same = first is second
    ones = np.bitwise_count(fp).astype(np.int16)
    left, right = [], []
    for i in range(0, len(first), tile):
        a = first[i : i + tile]
        for j in range(i if same else 0, len(second), tile):
            b = second[j : j + tile]
            if ones[b[0]] - ones[a[-1]] > radius:
                break
            if ones[a[0]] - ones[b[-1]] > radius:
                continue
            x, y = np.nonzero(np.bitwise_count(fp[a][:, None] ^ fp[b][None, :]) <= radius)
            left.append(a[x])
            right.append(b[y])
    none = np.empty(0, np.int64)
    return (np.concatenate(left), np.concatenate(right)) if left else (none, none)


def tile_links(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """Links within groups of consecutive rows of equal (choice, part, one, two): a forest of each."""

    def links(rows: pa.Table) -> pa.RecordBatch:
        choice, part, one, two, mine, fp = (rows.column(c).to_numpy() for c in ("choice", "part", "one", "two", "mine", "fingerprint"))
        fp = fp.view(np.uint64)
        cuts = np.flatnonzero((np.diff(choice) != 0) | (np.diff(part) != 0) | (np.diff(one) != 0) | (np.diff(two) != 0)) + 1
        starts, ends = np.r_[0, cuts], np.r_[cuts, len(fp)]
        group = np.repeat(np.arange(len(starts)), ends - starts)
        order = np.lexsort((np.bitwise_count(fp), group))
        fp, mine, one, two = fp[order], mine[order], one[order], two[order]
        lefts, rights = [], []
        small = ends - starts <= 48
        in_small = np.flatnonzero(small[group])
        shift = 1
        while len(in_small := in_small[in_small + shift < ends[group[in_small]]]):  # pairs at this distance in the order
            near = in_small[np.bitwise_count(fp[in_small] ^ fp[in_small + shift]) <= radius]
            lefts.append(near)
            rights.append(near + shift)
            shift += 1
        for s, e in zip(starts[~small], ends[~small]):
            at = np.arange(s, e)
            a = at if one[s] == two[s] else at[mine[s:e] == one[s]]
            b = a if one[s] == two[s] else at[mine[s:e] == two[s]]
            x, y = compare(fp, a, b, radius)
            lefts.append(x)
            rights.append(y)
        a, b = np.concatenate([*lefts, np.empty(0, np.int64)]), np.concatenate([*rights, np.empty(0, np.int64)])
        nodes, at = np.unique(np.r_[a, b], return_inverse=True)
        root = local_roots(at[: len(a)], at[len(a) :], len(nodes))
        far = np.flatnonzero(fp[nodes] != fp[nodes[root]])
        forest = np.unique(np.c_[fp[nodes[far]], fp[nodes[root[far]]]].astype(np.uint64).reshape(-1, 2), axis=0).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(forest[:, 0]), pa.array(forest[:, 1])], names=["a", "b"])

    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        key = [batch.column(c).to_numpy() for c in ("choice", "part", "one", "two")]
        new = np.flatnonzero(np.logical_or.reduce([np.diff(k) != 0 for k in key])) + 1
        if held and any(held[-1].column(c)[-1].as_py() != batch.column(c)[0].as_py() for c in ("choice", "part", "one", "two")):
            yield links(pa.Table.from_batches(held))
            held = []
        last = int(new[-1]) if len(new) else 0
        if last:
            yield links(pa.Table.from_batches([*held, batch.slice(0, last)]))
            held = []
        held.append(batch.slice(last))
    if held:
        yield links(pa.Table.from_batches(held))


def tile_pairs(placed: DataFrame, large: DataFrame, radius: int, tile: int) -> DataFrame:
    """placed (choice, part, fingerprint, ones), each row once for every pair of tiles (one, two) that its tile (mine) is in.

    The buckets in large have tiles of about `tile` fingerprints, ascending by bits
    set, and the pairs whose bit counts come within the radius; all others are one tile.
    """
    bucket = ["choice", "part"]
    counts = placed.join(large, bucket, "left_semi").groupBy(*bucket, "ones").agg(F.count("*").alias("n"))
    before = Window.partitionBy(*bucket).orderBy("ones").rowsBetween(Window.unboundedPreceding, -1)
    steps = materialise(counts.select(*bucket, "ones", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")), "steps")
    place = F.floor((F.col("before") + F.pmod(F.xxhash64("fingerprint"), F.col("n"))) / tile).cast("int")
    tiled = materialise(placed.join(steps, [*bucket, "ones"], "left").select(*bucket, "fingerprint", "ones", place.alias("mine")), "tiled")
    edges = materialise(tiled.where("mine is not null").groupBy(*bucket, "mine").agg(F.min("ones").alias("low"), F.max("ones").alias("high")), "edges")
    first, second = (edges.select(*bucket, F.col("mine").alias(c), F.col("low").alias(f"{c}_low"), F.col("high").alias(f"{c}_high")) for c in ("one", "two"))
    near = first.join(second, bucket).where((F.col("one") <= F.col("two")) & (F.col("two_low") - F.col("one_high") <= radius))
    own = near.select(*bucket, F.struct("one", "two").alias("pair"), F.explode(F.array_distinct(F.array("one", "two"))).alias("mine"))
    lists = own.groupBy(*bucket, "mine").agg(F.collect_list("pair").alias("pairs"))
    alone = F.array(F.struct(F.lit(0).alias("one"), F.lit(0).alias("two")))
    spread = tiled.join(lists, [*bucket, "mine"], "left").select(*bucket, F.coalesce("mine", F.lit(0)).alias("mine"), "fingerprint", F.explode(F.coalesce("pairs", alone)).alias("pair"))
    return spread.select(*bucket, "pair.*", "mine", "fingerprint")


def near_links(distinct: DataFrame, n: int, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """Links (a, b) that join all fingerprints within the radius of one another; n: rows of distinct."""
    placed = distinct.select("fingerprint", F.explode(buckets(F.col("fingerprint"), block_count(n, radius, tile), radius)).alias("at")).select("fingerprint", "at.*")
    large = materialise(placed.groupBy("choice", "part").agg(F.count("*").alias("members")).where(F.col("members") > tile).drop("members"), "large")
    ones = F.bit_count("fingerprint").cast("int")
    pairs = placed.select("choice", "part", *(F.lit(0).alias(c) for c in ("one", "two", "mine")), "fingerprint")
    if not large.isEmpty():
        pairs = tile_pairs(placed.withColumn("ones", ones), large, radius, tile)
    key = ["choice", "part", "one", "two"]
    dealt = pairs.repartition(partitions(distinct.sparkSession), *key).sortWithinPartitions(*key, ones)
    return dealt.mapInArrow(partial(tile_links, radius=radius), "a long, b long")


def near_duplicates(marked: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """marked(doc_id, fingerprint, ...) with component_id, the smallest doc_id linked over any chain, and root, a fingerprint of its component."""
    distinct = materialise(marked.groupBy("fingerprint").agg(F.min("doc_id").alias("first")), "distinct")
    links = materialise(near_links(distinct, distinct.count(), radius, tile), "near")
    found = components(links)
    rooted = distinct.join(found.withColumnRenamed("node", "fingerprint"), "fingerprint", "left").withColumn("root", F.coalesce("root", "fingerprint"))
    rooted = materialise(rooted, "rooted")
    release(links, distinct, found)
    least = materialise(rooted.groupBy("root").agg(F.min("first").alias("component_id")), "least")
    named = materialise(rooted.join(least, "root").select("fingerprint", "root", "component_id"), "named")
    release(rooted, least)
    return marked.join(named, "fingerprint")


def dedup_simhash(docs: DataFrame, radius: int = RADIUS, words: int = WORDS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id of every row of docs."""
    marked = fingerprints(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), ("doc_id",), words)
    found = near_duplicates(materialise(marked, "fingerprints"), radius)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")


def keep_first_of_groups(docs: DataFrame, radius: int = RADIUS, words: int = WORDS) -> DataFrame:
    """The rows of docs, with all their columns, less all but one of each group of near-duplicates.

    The smallest id stays; a null id only where there is no other; of rows equal
    in id and text any one.
    """
    rows = docs.select("*", *(c.alias(f"hf_{k}") for k, c in zip(("key_a", "key_b"), row_key("doc_id", "text"))))
    marked = materialise(fingerprints(rows, ("doc_id", "hf_key_a", "hf_key_b"), words), "fingerprints")
    least = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "hf_key_a", "hf_key_b")).alias("least")
    first = materialise(near_duplicates(marked, radius).groupBy("root").agg(least).select("least.hf_key_a", "least.hf_key_b"), "first")
    return rows.join(first, ["hf_key_a", "hf_key_b"], "left_semi").dropDuplicates(["hf_key_a", "hf_key_b"]).select(*docs.columns)
