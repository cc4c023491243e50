"""Queries of concentration, joins, linkage, text, features and profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import contains_flags, date_parts, first_contained, parse_date, sanitise_columns
from ..functions.text import ENGLISH_STOPWORDS, normalise, vocabulary
from ..operators import concentration, features, linkage, profile, relational
from ..sources.readers import extract
from ..specs import EXACT, LOOSE, NAME_KEYWORDS, PASSES, RECOMMEND, ExtractSpec, FeatureSpec, HoldingsSpec, JoinSpec, RegisterSpec, TextSpec
from .registry import query, rounded

# Concentration


def _order_holdings(read) -> DataFrame:
    return read("orders").select(F.col("o_custkey").alias("Owner_ID"), F.col("o_totalprice").alias("Value_Held"), "o_orderkey")


_SHARES = """
    WITH totals AS (SELECT o_custkey AS Owner_ID, sum(o_totalprice) AS value FROM orders GROUP BY 1),
    shares AS (SELECT *, value / (SELECT sum(value) FROM totals) AS share FROM totals),
    ranked AS (
        SELECT *, sum(share) OVER (ORDER BY share DESC, Owner_ID ROWS UNBOUNDED PRECEDING) AS cumsum_share,
               rank() OVER (ORDER BY share DESC)::INTEGER AS rank FROM shares)"""


@query(_SHARES + " SELECT Owner_ID, round(value, 2) AS value, round(share, 9) AS share, round(cumsum_share, 9) AS cumsum_share, rank FROM ranked WHERE rank <= 10")
def big_players_rank(read):
    return rounded(concentration.big_players(_order_holdings(read), ["Owner_ID"]), value=2, share=9, cumsum_share=9)


@query(_SHARES + " SELECT Owner_ID, round(value, 2) AS value, round(share, 9) AS share, round(cumsum_share, 9) AS cumsum_share, rank FROM ranked WHERE cumsum_share <= 0.25")
def big_players_cumshare(read):
    return rounded(concentration.big_players(_order_holdings(read), ["Owner_ID"], "cumsum_share", 0.25), value=2, share=9, cumsum_share=9)


@query(_SHARES + " SELECT o_orderkey, o_custkey AS Owner_ID, o_totalprice AS Value_Held FROM orders WHERE o_custkey NOT IN (SELECT Owner_ID FROM ranked WHERE rank <= 10)")
def big_players_rest(read):
    return concentration.concentration_cut(_order_holdings(read), ["Owner_ID"])[0]


# Relational core


@query("SELECT doc_id, lang, md5(text) AS text_md5 FROM documents QUALIFY count(*) OVER (PARTITION BY text) = 1")
def split_unique(read):
    return relational.split_unique(read("documents").select("text", "doc_id", "lang"), "text").select("doc_id", "lang", F.md5(F.col("text").cast("binary")).alias("text_md5"))


@query("SELECT doc_id, md5(text) AS text_md5, count(*) OVER (PARTITION BY text) AS count FROM documents QUALIFY count > 1")
def split_duplicates(read):
    return relational.split_duplicates(read("documents").select("text", "doc_id"), "text").select("doc_id", F.md5(F.col("text").cast("binary")).alias("text_md5"), "count")


@query("SELECT * FROM (SELECT nullif(p_brand, 'Brand#4') AS brand, p_partkey, count(*) OVER (PARTITION BY nullif(p_brand, 'Brand#4')) AS count FROM part) WHERE brand IS NOT NULL AND count > 1")
def split_duplicates_null_key(read):
    keyed = read("part").select(F.nullif(F.col("p_brand"), F.lit("Brand#4")).alias("brand"), "p_partkey")
    return relational.split_duplicates(keyed, "brand")


def _urgent(read) -> DataFrame:
    return read("orders").where("o_orderpriority = '1-URGENT'")


@query("SELECT * FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')")
def semi_join(read):
    return relational.key_join(read("customer"), _urgent(read), "c_custkey", "o_custkey", "semi")


@query("SELECT * FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')")
def anti_join(read):
    return relational.key_join(read("customer"), _urgent(read), "c_custkey", "o_custkey", "outer")


@query("SELECT c_custkey, c_name FROM customer JOIN orders ON c_custkey = o_custkey WHERE o_orderpriority = '1-URGENT'")
def inner_multiplying_join(read):
    return relational.key_join(read("customer"), _urgent(read), "c_custkey", "o_custkey", "inner").select("c_custkey", "c_name")


@query("SELECT l_orderkey, l_linenumber, o_orderstatus, c_name, n_name, r_name FROM lineitem LEFT JOIN (SELECT * FROM orders WHERE o_orderkey % 3 > 0) ON l_orderkey = o_orderkey LEFT JOIN (SELECT * FROM customer WHERE c_custkey % 4 > 0) ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey")
def join_chain(read):
    frames = {
        "lineitem": read("lineitem").select(F.col("l_orderkey").alias("orderkey"), "l_linenumber"),
        "orders": read("orders").where("o_orderkey % 3 > 0").select(F.col("o_orderkey").alias("orderkey"), F.col("o_custkey").alias("custkey"), "o_orderstatus"),
        "customer": read("customer").where("c_custkey % 4 > 0").select(F.col("c_custkey").alias("custkey"), F.col("c_nationkey").alias("nationkey"), "c_name"),
        "nation": read("nation").select(F.col("n_nationkey").alias("nationkey"), F.col("n_regionkey").alias("regionkey"), "n_name"),
        "region": read("region").select(F.col("r_regionkey").alias("regionkey"), "r_name"),
    }
    joined = relational.join_chain(frames, [JoinSpec("lineitem"), JoinSpec("orders", ("orderkey",)), JoinSpec("customer", ("custkey",)), JoinSpec("nation", ("nationkey",)), JoinSpec("region", ("regionkey",))])
    return joined.select(F.col("orderkey").alias("l_orderkey"), "l_linenumber", "o_orderstatus", "c_name", "n_name", "r_name")


@query("SELECT c_custkey AS key, c_name AS name FROM customer UNION ALL SELECT s_suppkey, s_name FROM supplier")
def union_by_name(read):
    return relational.union_all(read("customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name")), read("supplier").select(F.col("s_name").alias("name"), F.col("s_suppkey").alias("key")))


@query("SELECT c_custkey AS key, c_name AS name, c_mktsegment AS segment, NULL::DOUBLE AS balance FROM customer UNION ALL SELECT s_suppkey, s_name, NULL, s_acctbal FROM supplier")
def union_fill_missing(read):
    a = read("customer").select(F.col("c_name").alias("name"), F.col("c_custkey").alias("key"), F.col("c_mktsegment").alias("segment"))
    return relational.union_filled(a, read("supplier").select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance")))


@query("SELECT p_brand, p_partkey, p_name FROM part QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey, p_name) = 1")
def one_row_per(read):
    return relational.one_row_per(read("part").select("p_brand", "p_partkey", "p_name"), ["p_brand"])


@query("SELECT DISTINCT brand, size FROM (SELECT CASE WHEN p_size > 25 THEN p_brand END AS brand, TRY_CAST(p_size AS DOUBLE) AS size FROM part WHERE p_type IN ('PROMO', 'SMALL'))")
def extract_transform(read):
    rows = read("part").withColumn("p_brand", F.when(F.col("p_size") > 25, F.col("p_brand")))
    return extract(rows, ExtractSpec(cast={"p_size": "double"}, isin={"p_type": ["PROMO", "SMALL"]}, select=("p_brand", "p_size", "p_type"), drop=("p_type",), rename={"p_brand": "brand", "p_size": "size"}))


# Register and holdings


@query("""
    WITH register AS (
        SELECT p_name || ' ' || (p_partkey % 97)::VARCHAR AS idbr_name, p_brand AS esa,
               CASE WHEN p_size % 2 = 1 THEN DATE '2015-12-11' + p_size END AS death_date FROM part),
    coded AS (
        SELECT DISTINCT idbr_name, CASE WHEN contains(esa, '#12') THEN '#12' WHEN contains(esa, '#1') THEN '#1' WHEN contains(esa, '#2') THEN '#2' WHEN contains(esa, '4') THEN '4' END AS esa
        FROM register WHERE death_date > DATE '2016-01-01' OR death_date IS NULL)
    SELECT idbr_name, esa FROM coded WHERE esa IS NOT NULL QUALIFY count(*) OVER (PARTITION BY idbr_name) = 1""")
def register_filter_regroup(read):
    death = F.when(F.col("p_size") % 2 == 1, F.date_add(F.lit("2015-12-11").cast("date"), F.col("p_size")))
    register = read("part").select(F.concat("p_name", F.lit(" "), (F.col("p_partkey") % 97).cast("string")).alias("idbr_name"), F.col("p_brand").alias("esa"), death.alias("death_date"))
    return linkage.clean_register(register, RegisterSpec(codes=("#12", "#1", "#2", "4")))


@query("SELECT p_partkey, CASE WHEN contains(p_name, 'anvil') THEN 'anvil' WHEN contains(p_name, 'bolt') THEN 'bolt' WHEN contains(p_name, 'blue') THEN 'blue' END AS code FROM part")
def first_contained_code(read):
    return read("part").select("p_partkey", first_contained(F.col("p_name"), ["anvil", "bolt", "blue"]).alias("code"))


_SCOPE = """
    WITH holdings AS (
        SELECT (o_custkey % 1200) AS Owner_ID, c_name AS Owner_Name, CASE WHEN o_custkey % 7 > 0 THEN c_mktsegment END AS URL,
               CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN 'Individual Investor' WHEN o_custkey % 11 > 0 THEN c_mktsegment END AS Owner_Type,
               c_nationkey::VARCHAR AS Owner_Country_ID, o_orderdate::DATE AS Report_Date, o_orderkey
        FROM orders JOIN customer ON o_custkey = c_custkey),
    scope AS (
        SELECT * FROM holdings WHERE Owner_Country_ID IN ('1', '5', '9', '13', '20') AND Report_Date BETWEEN DATE '1996-01-01' AND DATE '1997-12-31' AND Owner_Type <> 'Individual Investor'),
    owners AS (SELECT DISTINCT Owner_ID, Owner_Name, URL, Owner_Type FROM scope WHERE Owner_Name IS NOT NULL AND URL IS NOT NULL AND Owner_Type IS NOT NULL),
    counted AS (SELECT *, count(*) OVER (PARTITION BY Owner_ID) AS count FROM owners)"""
_HOLDINGS = HoldingsSpec(start_date="1996-01-01", end_date="1997-12-31", countries=("1", "5", "9", "13", "20"))


def _holdings(read) -> DataFrame:
    joined = read("orders").join(read("customer"), F.col("o_custkey") == F.col("c_custkey"))
    kind = F.when(F.col("c_mktsegment") == "AUTOMOBILE", "Individual Investor").when(F.col("o_custkey") % 11 > 0, F.col("c_mktsegment"))
    return joined.select((F.col("o_custkey") % 1200).alias("Owner_ID"), F.col("c_name").alias("Owner_Name"), F.when(F.col("o_custkey") % 7 > 0, F.col("c_mktsegment")).alias("URL"), kind.alias("Owner_Type"), F.col("c_nationkey").cast("string").alias("Owner_Country_ID"), F.col("o_orderdate").cast("date").alias("Report_Date"), "o_orderkey")


@query(_SCOPE + " SELECT o_orderkey, Owner_ID, Owner_Name FROM scope")
def holdings_filter(read):
    return linkage.within_scope(_holdings(read), _HOLDINGS).select("o_orderkey", "Owner_ID", "Owner_Name")


@query(_SCOPE + " SELECT o_orderkey, Owner_ID, Owner_Name FROM scope WHERE Owner_ID IN (SELECT Owner_ID FROM counted WHERE count = 1)")
def holdings_clean(read):
    return linkage.clean_holdings(_holdings(read), _HOLDINGS)[0].select("o_orderkey", "Owner_ID", "Owner_Name")


@query(_SCOPE + " SELECT Owner_ID, Owner_Name, URL, Owner_Type, count FROM counted WHERE count > 1")
def holdings_ids_dups(read):
    return linkage.clean_holdings(_holdings(read), _HOLDINGS)[1]


# Text


def normalised_sql(column: str, spec: TextSpec) -> str:
    """The token list of a profile in SQL."""
    s = column
    if spec.lower_case:
        s = f"lower({s})"
    if spec.remove_punc:
        s = rf"regexp_replace({s}, '[^\w\s]', '', 'g')"
    if spec.remove_nums:
        s = rf"regexp_replace({s}, '[\d+]', '', 'g')"
    for old, new in spec.replace.items():
        s = f"regexp_replace({s}, '{old}', '{new}', 'g')"
    s = rf"list_filter(string_split_regex(lower({s}), '\W'), lambda t: length(t) >= {spec.min_token_length})"
    if spec.remove_stopwords:
        words = ", ".join("'" + w.replace("'", "''") + "'" for w in (*ENGLISH_STOPWORDS, *spec.extra_stopwords))
        s = f"list_filter({s}, lambda t: NOT list_contains([{words}], t))"
    return f"list_sort({s})" if spec.sort_tokens else s


def _joined_tokens(read, table: str, keys: list[str], spec: TextSpec) -> DataFrame:
    return read(table).select(*keys, F.array_join(normalise(F.col("text"), spec), " ").alias("tokens"))


@query(f"SELECT doc_id, array_to_string({normalised_sql('text', EXACT)}, ' ') AS tokens FROM documents")
def text_normalise_exact(read):
    return _joined_tokens(read, "documents", ["doc_id"], EXACT)


@query(f"SELECT doc_id, array_to_string({normalised_sql('text', LOOSE)}, ' ') AS tokens FROM documents")
def text_normalise_loose(read):
    return _joined_tokens(read, "documents", ["doc_id"], LOOSE)


@query(f"SELECT conv_id, turn, array_to_string({normalised_sql('text', RECOMMEND)}, ' ') AS tokens FROM conversations")
def text_normalise_recommend(read):
    return _joined_tokens(read, "conversations", ["conv_id", "turn"], RECOMMEND)


@query(r"""
    WITH counts AS (SELECT t AS exploded, count(*) AS count FROM (SELECT unnest(list_filter(string_split_regex(lower(text), '\W'), lambda t: length(t) >= 1)) AS t FROM documents) GROUP BY 1)
    SELECT (rank() OVER (ORDER BY count DESC) - 1)::INTEGER AS id, exploded, count FROM counts""")
def word_vocabulary(read):
    return vocabulary(read("documents"), "text")


@query(f"SELECT c_custkey, {', '.join(f'''CASE WHEN contains(lower(c_name), '{w}') THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END{" + CASE WHEN contains(lower(c_name), 'limited') THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END" if w == "ltd" else ""} AS {w}''' for w in NAME_KEYWORDS)} FROM (SELECT c_custkey, c_mktsegment || ' holdings ltd' AS c_name FROM customer)")
def keyword_flags(read):
    named = read("customer").select("c_custkey", F.concat("c_mktsegment", F.lit(" Holdings Ltd")).alias("name"))
    return named.select("c_custkey", *(x.alias(w) for w, x in contains_flags(F.col("name"), NAME_KEYWORDS, lower=True).items()))


# Linkage


def _sides(read) -> tuple[DataFrame, DataFrame]:
    """Even documents are a register, odd ones owners, as are copies of every tenth under a longer name."""
    docs = read("documents").select("doc_id", "text", "lang")
    register = docs.where("doc_id % 2 = 0").select(F.col("text").alias("idbr_name"), F.col("lang").alias("esa"))
    odd = docs.where("doc_id % 2 = 1").select(F.col("doc_id").alias("Owner_ID"), F.col("text").alias("Owner_Name"))
    renamed = docs.where("doc_id % 10 = 0").select((F.col("doc_id") + 10_000_000).alias("Owner_ID"), F.concat(F.lit("The and "), "text").alias("Owner_Name"))
    return register, odd.unionByName(renamed)


def pass_sql(n: int, spec: TextSpec, least: int) -> str:
    return f"""
    left{n} AS (SELECT Owner_ID, name_ FROM (SELECT Owner_ID, {normalised_sql("Owner_Name", spec)} AS name_ FROM owners{n}) QUALIFY count(*) OVER (PARTITION BY name_) = 1),
    right{n} AS (
        SELECT * FROM (
            SELECT * FROM (SELECT idbr_name, esa, {normalised_sql("idbr_name", spec)} AS name_ FROM register{n}) QUALIFY row_number() OVER (PARTITION BY name_, esa ORDER BY idbr_name) = 1)
        QUALIFY count(*) OVER (PARTITION BY name_) = 1),
    found{n} AS (SELECT * FROM left{n} JOIN right{n} USING (name_) WHERE len(name_) >= {least})"""


LINK = f"""
    WITH register1 AS (SELECT text AS idbr_name, lang AS esa FROM documents WHERE doc_id % 2 = 0),
    owners1 AS (
        SELECT doc_id AS Owner_ID, text AS Owner_Name FROM documents WHERE doc_id % 2 = 1
        UNION ALL SELECT doc_id + 10000000, 'The and ' || text FROM documents WHERE doc_id % 10 = 0),
    {pass_sql(1, EXACT, 0)}"""


@query(LINK + " SELECT Owner_ID, esa FROM found1")
def link_exact(read):
    return linkage.link(*_sides(read), PASSES[:1])[1]


LINK_TWICE = f"""{LINK},
    register2 AS (SELECT * FROM register1 WHERE idbr_name NOT IN (SELECT idbr_name FROM found1)),
    owners2 AS (SELECT * FROM owners1 WHERE Owner_ID NOT IN (SELECT Owner_ID FROM found1)),
    {pass_sql(2, LOOSE, 3)}"""


@query(LINK_TWICE + " SELECT Owner_ID, esa FROM found1 UNION ALL SELECT Owner_ID, esa FROM found2")
def link_two_pass(read):
    return linkage.link(*_sides(read))[1]


@query(LINK_TWICE + " SELECT md5(idbr_name) AS name_md5, esa FROM register2 WHERE idbr_name NOT IN (SELECT idbr_name FROM found2)")
def link_rest(read):
    return linkage.link(*_sides(read))[0].select(F.md5(F.col("idbr_name").cast("binary")).alias("name_md5"), "esa")


def part_sides(read) -> tuple[DataFrame, DataFrame]:
    parts = read("part")
    owners = parts.select(F.col("p_partkey").alias("Owner_ID"), F.concat(F.lit("The "), F.initcap("p_name")).alias("Owner_Name"))
    return owners, parts.select(F.col("p_name").alias("idbr_name"), F.col("p_brand").alias("esa")).distinct()


def top_words_sql(source: str, column: str, n: int) -> str:
    return rf"SELECT t FROM (SELECT t, rank() OVER (ORDER BY count(*) DESC) AS r FROM (SELECT unnest(list_filter(string_split_regex(lower({column}), '\W'), lambda t: length(t) >= 1)) AS t FROM {source}) GROUP BY t) WHERE r <= {n}"


@query(f"""
    WITH owners AS (SELECT p_partkey AS Owner_ID, 'The ' || p_name AS Owner_Name FROM part),
    register AS (SELECT DISTINCT p_name AS idbr_name, p_brand AS esa FROM part),
    common AS (SELECT list(DISTINCT t) AS words FROM ({top_words_sql("owners", "Owner_Name", 2)} UNION ALL {top_words_sql("register", "idbr_name", 2)})),
    l AS (SELECT Owner_ID, list_filter({normalised_sql("Owner_Name", RECOMMEND)}, lambda t: NOT list_contains(words, t)) AS name_ FROM owners, common),
    r AS (SELECT idbr_name, esa, list_filter({normalised_sql("idbr_name", RECOMMEND)}, lambda t: NOT list_contains(words, t)) AS name_ FROM register, common)
    SELECT Owner_ID, idbr_name, esa FROM l LEFT JOIN r ON l.name_ = r.name_ AND len(r.name_) > 0""")
def link_candidates(read):
    return linkage.candidate_pairs(*part_sides(read), n_common=2).select("Owner_ID", "idbr_name", "esa")


# Features


_SOURCES = "(SELECT doc_id, lang, CASE WHEN doc_id % 7 = 0 THEN NULL WHEN doc_id % 11 = 0 THEN 'rare ' || source WHEN doc_id % 5 < 2 THEN 'often' ELSE source END AS source FROM documents)"


def _sources(read) -> DataFrame:
    part = F.when(F.col("doc_id") % 11 == 0, F.concat(F.lit("rare "), "source")).when(F.col("doc_id") % 5 < 2, "often").otherwise(F.col("source"))
    return read("documents").select("doc_id", "lang", F.when(F.col("doc_id") % 7 > 0, part).alias("source"))


@query(f"SELECT doc_id, lang, CASE WHEN source IS NOT NULL AND count(*) OVER (PARTITION BY source) < 0.025 * count(*) OVER () THEN 'other' ELSE source END AS source FROM {_SOURCES}")
def fold_category_fraction(read):
    return relational.fold_categories(_sources(read), ["source"], 0.025)


@query(f"""
    WITH counted AS (SELECT *, count(*) OVER (PARTITION BY source) AS n, count(*) OVER (PARTITION BY lang) AS m, count(*) OVER () AS total FROM {_SOURCES}),
    rare AS (SELECT count(DISTINCT source) FILTER (n < 0.025 * total) AS k, count(DISTINCT lang) FILTER (m < 0.12 * total) AS j FROM counted)
    SELECT doc_id, CASE WHEN lang IS NOT NULL AND m < 0.12 * total AND j >= 2 THEN 'other' ELSE lang END AS lang,
           CASE WHEN source IS NOT NULL AND n < 0.025 * total AND k >= 2 THEN 'other' ELSE source END AS source FROM counted, rare""")
def fold_several_rare(read):
    """A column with fewer than two rare values is left alone."""
    once = relational.fold_categories(_sources(read), ["source"], 0.025, min_rare=2)
    return relational.fold_categories(once, ["lang"], 0.12, min_rare=2)


@query("""
    WITH counted AS (SELECT p_partkey, nullif(p_brand, 'Brand#9') AS brand, count(*) OVER (PARTITION BY p_brand) AS n FROM part),
    edge AS (SELECT quantile_disc(n, 0.5) AS least FROM (SELECT DISTINCT brand, 80 AS n FROM counted)),
    rare AS (SELECT string_agg(brand, '_' ORDER BY brand) AS label FROM (SELECT DISTINCT brand, n FROM counted) WHERE brand IS NOT NULL AND n < (SELECT least FROM edge))
    SELECT p_partkey, CASE WHEN brand IS NOT NULL AND n < (SELECT least FROM edge) THEN (SELECT label FROM rare) ELSE brand END AS brand FROM counted""")
def fold_category_concat(read):
    return relational.fold_categories(read("part").select("p_partkey", F.nullif(F.col("p_brand"), F.lit("Brand#9")).alias("brand")), ["brand"], 80, concat=True)


_PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
_STATUSES = ("F", "O", "P")


@query(f"SELECT o_orderkey, {', '.join(f'''(o_orderstatus = '{s}')::INTEGER AS o_orderstatus{s}''' for s in _STATUSES)} FROM orders")
def dummy_columns(read):
    flagged, _ = features.dummies(read("orders").select("o_orderkey", "o_orderstatus"), ["o_orderstatus"], keep=False)
    return sanitise_columns(flagged)


def _dynamic_sql() -> str:
    flags = {f"o_orderpriority{''.join(ch for ch in v if ch.isalnum())}": f"(o_orderpriority = '{v}')::INTEGER" for v in _PRIORITIES} | {f"o_orderstatus{v}": f"(o_orderstatus = '{v}')::INTEGER" for v in _STATUSES}
    numbers = {"o_totalprice": "o_totalprice", "month": "month(o_orderdate)", "dayofmonth": "day(o_orderdate)", "dayofweek": "dayofweek(o_orderdate) + 1", "quarter": "quarter(o_orderdate)"}
    cells = [f"round({f}({x})::DOUBLE, 7) AS {f}{n}" for f in ("avg", "sum") for n, x in flags.items()] + [f"round({f}({x})::DOUBLE, 7) AS {f}{n}" for f in ("avg", "sum", "min", "max") for n, x in numbers.items()]
    return f"SELECT o_custkey, count(*)::DOUBLE AS count, {', '.join(cells)} FROM orders GROUP BY o_custkey"


@query(_dynamic_sql())
def dynamic_features(read):
    spec = FeatureSpec(id_col="o_custkey", dynamic_categorical=("o_orderpriority", "o_orderstatus"), dynamic_numerical=("o_totalprice",), dynamic_date=("o_orderdate",), fold_share=0.05)
    table = sanitise_columns(features.dynamic_features(read("orders"), spec))
    return table.select("o_custkey", "count", *(F.round(c, 7).alias(c) for c in table.columns if c not in ("o_custkey", "count")))


@query("SELECT c_custkey, c_name, CASE WHEN count(*) OVER (PARTITION BY c_nationkey) < 0.05 * count(*) OVER () THEN 'other' ELSE c_nationkey::VARCHAR END AS nation, c_mktsegment, c_acctbal, CASE WHEN contains(c_name, 'fund') THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS fund, CASE WHEN contains(c_name, 'Customer') THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS Customer FROM customer")
def static_features(read):
    spec = FeatureSpec(id_col="c_custkey", static_text=("c_name",), static_categorical=("nation", "c_mktsegment"), static_numerical=("c_acctbal",), keywords=("fund", "Customer"))
    return features.static_features(read("customer").withColumn("nation", F.col("c_nationkey").cast("string")), spec)


@query("SELECT c_custkey, c_mktsegment, round(1 / (n * total), 9) AS weight FROM customer JOIN (SELECT c_mktsegment, count(*) AS n, sum(1 / count(*)) OVER () AS total FROM customer GROUP BY 1) USING (c_mktsegment)")
def class_weights(read):
    return rounded(relational.class_weights(read("customer").select("c_custkey", "c_mktsegment"), "c_mktsegment"), weight=9)


@query("SELECT o_orderkey, month(o_orderdate)::INTEGER AS month, day(o_orderdate)::INTEGER AS dayofmonth, (dayofweek(o_orderdate) + 1)::INTEGER AS dayofweek, quarter(o_orderdate)::INTEGER AS quarter FROM orders")
def order_date_parts(read):
    return read("orders").select("o_orderkey", *(x.alias(n) for n, x in date_parts(F.col("o_orderdate")).items()))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 5 > 0 THEN o_orderdate::DATE END AS parsed FROM orders")
def parsed_dates(read):
    text: Column = F.when(F.col("o_orderkey") % 5 == 0, F.lit("1996-31-31")).otherwise(F.concat(F.lit(" "), F.date_format("o_orderdate", "dd/MM/yyyy")))
    return read("orders").select("o_orderkey", parse_date(text).alias("parsed"))


# Profiles


@query("SELECT p_brand, count(*) AS count FROM part GROUP BY 1")
def value_counts(read):
    return relational.value_counts(read("part"), "p_brand")


@query("SELECT p_brand, count(*) AS count FROM part GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5")
def value_counts_top(read):
    return relational.value_counts(read("part"), "p_brand", 5)


@query("SELECT count(*) AS n FROM (SELECT DISTINCT nullif(p_brand, 'Brand#4') FROM part)")
def nunique_with_null(read):
    return relational.nunique(read("part").select(F.nullif(F.col("p_brand"), F.lit("Brand#4")).alias("brand")), "brand")


@query("SELECT DISTINCT nullif(p_brand, 'Brand#4') AS brand FROM part")
def unique_values(read):
    return relational.unique(read("part").select(F.nullif(F.col("p_brand"), F.lit("Brand#4")).alias("brand")), "brand")


@query("SELECT 'quality' AS \"column\", round(avg((quality IS NULL)::INTEGER) * 100, 6) AS missing_pct FROM documents LEFT JOIN labels USING (doc_id) UNION ALL SELECT 'n_chars', round(avg((n_chars > 2000 OR quality = 1)::INTEGER) * 100, 6) FROM (SELECT n_chars, coalesce(quality, 0) AS quality FROM documents LEFT JOIN labels USING (doc_id))")
def missing_report(read):
    joined = read("documents").join(read("labels"), "doc_id", "left")
    long = (F.col("n_chars") > 2000) | (F.coalesce("quality", F.lit(0)) == 1)
    joined = joined.select("quality", F.when(~long, F.col("n_chars")).alias("n_chars"), "lang")
    return rounded(profile.missing_report(joined), missing_pct=6)


@query("""
    WITH cells AS (SELECT 'o_orderstatus' AS "column", nullif(o_orderstatus, 'P') AS value FROM orders UNION ALL SELECT 'o_orderpriority', o_orderpriority FROM orders),
    counts AS (SELECT "column", value, count(*) AS count FROM cells GROUP BY ALL),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY count DESC, value NULLS FIRST)::INTEGER AS place,
               count(*) OVER (PARTITION BY "column") AS n_values, sum(CASE WHEN value IS NULL THEN count ELSE 0 END) OVER (PARTITION BY "column")::BIGINT AS n_null,
               sum(count) OVER (PARTITION BY "column") AS total FROM counts)
    SELECT "column", 'string' AS dtype, n_values, n_null, place, value, count, round(count / total * 100, 6) AS total_pct FROM ranked WHERE place <= 3""")
def column_profile(read):
    rows = read("orders").select(F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("o_orderstatus"), "o_orderpriority")
    return rounded(profile.profile(rows, top_n=3), total_pct=6)


@query("WITH top AS (SELECT p_brand AS value, count(*) AS n FROM part GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10) SELECT value, round(n / sum(n) OVER (), 9) AS frequency FROM top")
def top_frequencies(read):
    return rounded(profile.frequencies(read("part"), "p_brand", 10, normalize=True), frequency=9)


@query(f"SELECT o_orderpriority, {', '.join(f'''count(*) FILTER (o_orderstatus = '{s}') AS {s}''' for s in _STATUSES)} FROM orders GROUP BY 1")
def status_crosstab(read):
    return profile.crosstab(read("orders"), "o_orderpriority", "o_orderstatus")


@query("SELECT (quality IS NOT NULL)::INTEGER AS sectorised, sum(n_chars)::DOUBLE AS value FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1")
def coverage_by_value(read):
    return profile.coverage_by_value(read("documents"), read("labels"), "doc_id", "n_chars", "quality")


@query("SELECT count(quality) AS matched, count(*) AS total FROM documents LEFT JOIN labels USING (doc_id)")
def coverage_by_number(read):
    return profile.coverage(read("documents"), read("labels"), "doc_id", "quality")
