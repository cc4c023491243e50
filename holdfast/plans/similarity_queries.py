"""Queries of the similarity battery and of recommendations.

Their SQL restates the metrics: matching blocks by a recursion over the longest
common part of two strings and what is left and right of it, common subsequences by
a recursion over the characters of one side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.similarity import METHODS, score_pairs
from ..operators import linkage
from ..specs import RECOMMEND
from .queries import normalised_sql, part_sides, top_words_sql
from .registry import query, rounded


def _name_pairs(read) -> DataFrame:
    a = read("part").select("p_partkey", F.col("p_name").alias("a"))
    b = read("part").select((F.col("p_partkey") - 1).alias("p_partkey"), F.col("p_name").alias("b"))
    return a.join(b, "p_partkey")


_PAIRS = "(SELECT x.p_partkey AS p_partkey, x.p_name AS a, y.p_name AS b FROM part x JOIN part y ON x.p_partkey = y.p_partkey - 1)"
_CHARS = "list_distinct(string_split({}, ''))"
_BOTH = f"len(list_intersect({_CHARS.format('a')}, {_CHARS.format('b')}))"
_GRAMS = "list_distinct([substr({0}, i, 3) for i in range(1, length({0}) - 1)])"
_BOTH_GRAMS = f"len(list_intersect({_GRAMS.format('a')}, {_GRAMS.format('b')}))"
_SETS = {
    "jaccard_chars": "round(1 - jaccard(a, b), 6)",
    "jaccard_ngrams_chars": f"round(1 - {_BOTH_GRAMS} / (len({_GRAMS.format('a')}) + len({_GRAMS.format('b')}) - {_BOTH_GRAMS}), 6)",
    "sorensen": f"round(1 - 2 * {_BOTH} / (len({_CHARS.format('a')}) + len({_CHARS.format('b')})), 6)",
    "edit_distance": "levenshtein(a, b)::INTEGER",
    "pyjaro": "round(jaro_winkler_similarity(a, b), 6)",
}


@query(f"SELECT p_partkey, {', '.join(f'{x} AS {n}' for n, x in _SETS.items())} FROM {_PAIRS}")
def similarity_scores(read):
    methods = ("jaccard_chars", "jaccard_ngrams_chars", "sorensen", "edit_distance", "pyjaro")
    scored = score_pairs(_name_pairs(read), "a", "b", methods).select("p_partkey", *methods)
    return rounded(scored, jaccard_chars=6, jaccard_ngrams_chars=6, sorensen=6, pyjaro=6)


def _long_name(prefix: str = "") -> str:
    return f"{prefix}p_name || ' of ' || lower({prefix}p_type) || ' ' || {prefix}p_name"


_WORDS = "list_distinct(string_split_regex({}, ' '))"
_TRIPLES = "list_distinct([array_to_string(string_split({0}, ' ')[i:i + 2], ' ') for i in range(1, len(string_split({0}, ' ')) - 1)])"


def _jaccard(of: str) -> str:
    both = f"len(list_intersect({of.format('a')}, {of.format('b')}))"
    return f"round(1 - {both} / (len({of.format('a')}) + len({of.format('b')}) - {both}), 6)"


@query(f"SELECT p_partkey, {_jaccard(_WORDS)} AS jaccard_tokens, {_jaccard(_TRIPLES)} AS jaccard_ngrams_tokens FROM (SELECT x.p_partkey AS p_partkey, {_long_name('x.')} AS a, {_long_name('y.')} AS b FROM part x JOIN part y ON x.p_partkey = y.p_partkey - 1)")
def similarity_tokens(read):
    name = F.concat_ws(" ", "p_name", F.lit("of"), F.lower("p_type"), "p_name")
    a = read("part").select("p_partkey", name.alias("a"))
    b = read("part").select((F.col("p_partkey") - 1).alias("p_partkey"), name.alias("b"))
    scored = score_pairs(a.join(b, "p_partkey"), "a", "b", ("jaccard_tokens", "jaccard_ngrams_tokens"))
    return rounded(scored.select("p_partkey", "jaccard_tokens", "jaccard_ngrams_tokens"), jaccard_tokens=6, jaccard_ngrams_tokens=6)


def _longest(x: str, y: str) -> str:
    """[length, -place in x] of the longest common part, the first in x of the longest; [0, 0] if there is none."""
    return f"list_max(flatten([[CASE WHEN contains({y}, substr({x}, i, n)) THEN [n, -i] ELSE [0, 0] END for n in range(1, length({x}) - i + 2)] for i in range(1, length({x}) + 1)]))"


def _blocks(name: str, source: str) -> str:
    """Expressions of a WITH RECURSIVE: name(x, y, ax, ay, n), the matching blocks of source(x, y) by place."""
    place = "strpos(p, substr(o, -m[2], m[1]))"
    return f"""
    {name}_parts AS (
        SELECT x, y, x AS o, y AS p, 0::BIGINT AS ax, 0::BIGINT AS ay, {_longest("x", "y")} AS m FROM {source} WHERE x <> '' AND y <> ''
        UNION ALL
        SELECT x, y, o, p, ax, ay, {_longest("o", "p")} AS m FROM (
            SELECT x, y, CASE side WHEN 0 THEN substr(o, 1, -m[2] - 1) ELSE substr(o, -m[2] + m[1]) END AS o,
                   CASE side WHEN 0 THEN substr(p, 1, {place} - 1) ELSE substr(p, {place} + m[1]) END AS p,
                   ax + side * (-m[2] + m[1] - 1) AS ax, ay + side * ({place} + m[1] - 1) AS ay
            FROM {name}_parts, (VALUES (0), (1)) sides(side) WHERE m[1] > 0)
        WHERE o <> '' AND p <> ''),
    {name} AS (SELECT x, y, ax - m[2] - 1 AS ax, ay + strpos(p, substr(o, -m[2], m[1])) - 1 AS ay, m[1] AS n FROM {name}_parts WHERE m[1] > 0),
    {name}_ratio AS (SELECT x, y, CASE WHEN x = '' AND y = '' THEN 1.0::DOUBLE ELSE 2 * coalesce(matched, 0)::DOUBLE / (length(x) + length(y)) END AS ratio FROM {source} LEFT JOIN (SELECT x, y, sum(n) AS matched FROM {name} GROUP BY ALL) USING (x, y))"""


def _sorted_words(s: str) -> str:
    return f"list_sort(list_filter(string_split_regex(lower({s}), '[^a-z0-9]+'), lambda w: w <> ''))"


def _joined(*parts: str) -> str:
    return f"array_to_string(list_filter([{', '.join(parts)}], lambda w: w <> ''), ' ')"


def battery_sql(pairs: str) -> str:
    """Expressions of a WITH RECURSIVE: battery(a, b, ...), the metrics of the distinct pairs of names in pairs(a, b)."""
    rest = "array_to_string(list_filter({0}, lambda w: NOT list_contains({1}, w)), ' ')"
    percent = "round_even(100 * {}, 0)::INTEGER"
    return f"""
    named AS (SELECT DISTINCT lower(a) AS a, lower(b) AS b FROM {pairs} WHERE a IS NOT NULL AND b IS NOT NULL),
    worded AS (SELECT a, b, {_sorted_words("a")} AS s, {_sorted_words("b")} AS t FROM named),
    split AS (SELECT a, b, s, t, list_distinct(s) AS ds, list_distinct(t) AS dt FROM worded),
    common AS (SELECT a, b, s, t, array_to_string(list_sort(list_intersect(ds, dt)), ' ') AS shared, {rest.format("list_sort(ds)", "dt")} AS one, {rest.format("list_sort(dt)", "ds")} AS two FROM split),
    strings AS (
        SELECT a, b, CASE WHEN length(a) <= length(b) THEN a ELSE b END AS short, CASE WHEN length(a) <= length(b) THEN b ELSE a END AS long,
               array_to_string(s, ' ') AS sa, array_to_string(t, ' ') AS sb, shared, {_joined("shared", "one")} AS one, {_joined("shared", "two")} AS two FROM common),
    compared AS (SELECT a AS x, b AS y FROM strings UNION SELECT short, long FROM strings UNION SELECT sa, sb FROM strings UNION SELECT shared, one FROM strings UNION SELECT shared, two FROM strings UNION SELECT one, two FROM strings),
    {_blocks("matches", "compared")},
    starts AS (SELECT x, y, greatest(0, ay - ax) AS start FROM matches UNION SELECT x, y, length(y) - length(x) FROM compared WHERE length(y) >= length(x)),
    stretches AS (SELECT s.short, s.long, substr(s.long, (start + 1)::BIGINT, length(s.short)) AS stretch FROM strings s JOIN starts ON x = s.short AND y = s.long),
    aligned AS (SELECT DISTINCT short AS x, stretch AS y FROM stretches),
    {_blocks("inner_matches", "aligned")},
    partial AS (SELECT short, long, CASE WHEN short = '' THEN (long = '')::INTEGER ELSE max(ratio) END AS ratio FROM stretches JOIN inner_matches_ratio ON x = short AND y = stretch GROUP BY short, long),
    rows_ AS (
        SELECT a, b, 0::BIGINT AS i, [0::BIGINT for j in range(0, length(b))] AS row FROM named
        UNION ALL
        SELECT a, b, i + 1, [greatest(row[j], coalesce(list_max([CASE WHEN k > 1 THEN row[k - 1] ELSE 0 END + 1 for k in range(1, j + 1) if substr(b, k, 1) = substr(a, i + 1, 1)]), 0)) for j in range(1, length(b) + 1)] FROM rows_ WHERE i < length(a)),
    subsequences AS (SELECT a, b, CASE WHEN a = '' AND b = '' THEN 1.0::DOUBLE ELSE 2 * coalesce(row[length(b)], 0)::DOUBLE / (length(a) + length(b)) END AS ratio FROM rows_ WHERE i = length(a)),
    battery AS (
        SELECT s.a, s.b,
               {percent.format("whole.ratio")} AS fuzz_ratio, {percent.format("partial.ratio")} AS fuzz_partial_ratio, {percent.format("sorted.ratio")} AS fuzz_token_sort_ratio,
               greatest({percent.format("set1.ratio")}, {percent.format("set2.ratio")}, {percent.format("set3.ratio")}) AS fuzz_token_set_ratio,
               round(subsequences.ratio, 6) AS levenshtein, round(whole.ratio, 6) AS sequencematcher
        FROM strings s JOIN matches_ratio whole ON whole.x = s.a AND whole.y = s.b JOIN partial USING (short, long)
        JOIN matches_ratio sorted ON sorted.x = sa AND sorted.y = sb JOIN matches_ratio set1 ON set1.x = shared AND set1.y = one
        JOIN matches_ratio set2 ON set2.x = shared AND set2.y = two JOIN matches_ratio set3 ON set3.x = one AND set3.y = two
        JOIN subsequences ON subsequences.a = s.a AND subsequences.b = s.b)"""


RATIOS = ("fuzz_ratio", "fuzz_partial_ratio", "fuzz_token_sort_ratio", "fuzz_token_set_ratio", "levenshtein", "sequencematcher")


@query(f"WITH RECURSIVE pairs AS (SELECT * FROM {_PAIRS}), {battery_sql('pairs')} SELECT p_partkey, {', '.join(RATIOS)} FROM pairs p JOIN battery t ON t.a = lower(p.a) AND t.b = lower(p.b)")
def similarity_ratios(read):
    return rounded(score_pairs(_name_pairs(read), "a", "b", RATIOS).select("p_partkey", *RATIOS), levenshtein=6, sequencematcher=6)


#: The library's own battery, as recommendations show it.
SHOWN = tuple(m for m in METHODS if m not in ("jaccard_tokens", "jaccard_ngrams_tokens"))


@query(f"""
    WITH RECURSIVE owners AS (SELECT p_partkey AS Owner_ID, 'The ' || upper(p_name[1]) || regexp_replace(p_name[2:], ' .', ' ' || upper(regexp_extract(p_name, ' (.)', 1))) AS Owner_Name FROM part),
    register AS (SELECT DISTINCT p_name AS idbr_name, p_brand AS esa FROM part),
    common_words AS (SELECT list(DISTINCT t) AS words FROM ({top_words_sql("owners", "Owner_Name", 2)} UNION ALL {top_words_sql("register", "idbr_name", 2)})),
    l AS (SELECT Owner_ID, Owner_Name, list_filter({normalised_sql("Owner_Name", RECOMMEND)}, lambda t: NOT list_contains(words, t)) AS name_ FROM owners, common_words),
    r AS (SELECT idbr_name, esa, list_filter({normalised_sql("idbr_name", RECOMMEND)}, lambda t: NOT list_contains(words, t)) AS name_ FROM register, common_words),
    found AS (SELECT Owner_ID, Owner_Name, idbr_name, esa FROM l JOIN r ON l.name_ = r.name_ AND len(r.name_) > 0),
    pairs AS (SELECT Owner_Name AS a, idbr_name AS b FROM found), {battery_sql('pairs')},
    sets AS (SELECT a, b, {', '.join(f'{x} AS {n}' for n, x in _SETS.items())} FROM named)
    SELECT Owner_ID, Owner_Name, idbr_name, esa, {', '.join(SHOWN)} FROM found JOIN battery t ON t.a = lower(Owner_Name) AND t.b = lower(idbr_name) JOIN sets s ON s.a = t.a AND s.b = t.b""")
def recommendations(read):
    owners, register = part_sides(read)
    found = linkage.recommend(owners.select("Owner_ID"), owners, register, ["Owner_ID", "Owner_Name"], n_common=2)[0]
    places = {m: 6 for m in ("jaccard_chars", "jaccard_ngrams_chars", "sorensen", "levenshtein", "sequencematcher", "pyjaro")}
    return rounded(found.select("Owner_ID", "Owner_Name", "idbr_name", "esa", *SHOWN), **places)
