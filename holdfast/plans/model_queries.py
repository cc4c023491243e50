"""Queries of feature tables, samples, models, and of the labelling pipeline as a whole.

What a fitted model predicts has no SQL; its queries state what must hold for any fit.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import sanitise_columns
from ..operators import features, model, relational, sampling
from ..sources.readers import load_model
from ..sources.scratch import materialise, scratch_path
from ..sources.writers import save_model
from ..specs import EXACT, LOOSE, FeatureSpec, ModelSpec
from ..streaming import link_stream
from . import pipeline
from .queries import normalised_sql, pass_sql
from .registry import query, rounded

# Features


@query("SELECT o_orderkey, (o_orderstatus = 'F')::INTEGER AS o_orderstatus_F, (o_orderstatus = 'O')::INTEGER AS o_orderstatus_O FROM orders")
def dummies_without_null(read):
    """Null is zero throughout."""
    rows = read("orders").select("o_orderkey", F.nullif("o_orderstatus", F.lit("P")).alias("o_orderstatus"))
    return features.dummies(rows, ["o_orderstatus"], null_as=None, keep=False, sep="_")[0]


@query("SELECT o_orderkey, coalesce(nullif(o_orderstatus, 'P'), 'Null') AS o_orderstatus, (o_orderstatus = 'F')::INTEGER AS o_orderstatusF, (o_orderstatus = 'P')::INTEGER AS o_orderstatusNull, (o_orderstatus = 'O')::INTEGER AS o_orderstatusO FROM orders")
def dummies_with_null(read):
    """Null is a value of its own."""
    rows = read("orders").select("o_orderkey", F.nullif("o_orderstatus", F.lit("P")).alias("o_orderstatus"))
    return sanitise_columns(features.dummies(rows, ["o_orderstatus"])[0])


def _feature_sql() -> str:
    flags = {f"o_orderstatus{v}": f"(o_orderstatus = '{v}')::INTEGER" for v in "FOP"}
    numbers = {"o_totalprice": "o_totalprice", "month": "month(o_orderdate)", "dayofmonth": "day(o_orderdate)", "dayofweek": "dayofweek(o_orderdate) + 1", "quarter": "quarter(o_orderdate)"}
    cells = [f"round({f}({x})::DOUBLE, 6) AS {f}{n}" for f in ("avg", "sum") for n, x in flags.items()] + [f"round({f}({x})::DOUBLE, 6) AS {f}{n}" for f in ("avg", "sum", "min", "max") for n, x in numbers.items()]
    return f"""
    WITH labelled AS (SELECT c_custkey AS id, {_LABEL_SQL} AS label FROM customer WHERE c_custkey % 5 > 0),
    rare AS (SELECT label FROM labelled GROUP BY 1 HAVING count(*) < 50),
    folded AS (SELECT id, CASE WHEN label IN (SELECT label FROM rare) THEN (SELECT string_agg(label, '_' ORDER BY label) FROM rare) ELSE label END AS esa FROM labelled),
    static AS (SELECT c_custkey AS id, c_name, CASE WHEN count(*) OVER (PARTITION BY c_nationkey) < 0.04 * count(*) OVER () THEN 'other' ELSE c_nationkey::VARCHAR END AS nation, c_acctbal, CASE WHEN contains(c_name, '7') THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS "7" FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)),
    dynamic AS (SELECT o_custkey AS id, count(*)::DOUBLE AS count, {', '.join(cells)} FROM orders GROUP BY 1)
    SELECT * FROM static JOIN dynamic USING (id) LEFT JOIN folded USING (id)"""


_LABEL_SQL = "'S' || CASE WHEN c_custkey % 97 = 1 THEN 'x' WHEN c_custkey % 89 = 1 THEN 'y' ELSE (c_custkey % 3)::VARCHAR END"


@query(_feature_sql())
def feature_table(read):
    rows = read("orders").join(read("customer"), F.col("o_custkey") == F.col("c_custkey")).withColumns({"id": F.col("c_custkey"), "nation": F.col("c_nationkey").cast("string")})
    label = F.concat(F.lit("S"), F.when(F.col("c_custkey") % 97 == 1, "x").when(F.col("c_custkey") % 89 == 1, "y").otherwise((F.col("c_custkey") % 3).cast("string")))
    labels = read("customer").where("c_custkey % 5 > 0").select(F.col("c_custkey").alias("id"), label.alias("esa"))
    spec = FeatureSpec(id_col="id", static_text=("c_name",), static_categorical=("nation",), static_numerical=("c_acctbal",), keywords=("7",), dynamic_categorical=("o_orderstatus",), dynamic_numerical=("o_totalprice",), dynamic_date=("o_orderdate",), fold_share=0.04)
    table = features.feature_table(rows, labels, spec)
    return rounded(table, **{c: 6 for c in table.columns if c.startswith(("avg", "sum", "min", "max"))})


@query("""
    SELECT 'o_orderkey' AS "column", CASE WHEN max(o_orderkey) < 128 THEN 'tinyint' WHEN max(o_orderkey) < 32768 THEN 'smallint' WHEN max(o_orderkey) < 2147483648 THEN 'int' ELSE 'bigint' END AS type FROM orders
    UNION ALL SELECT 'month', 'tinyint' UNION ALL SELECT 'negative', CASE WHEN max(o_custkey) <= 128 THEN 'tinyint' WHEN max(o_custkey) <= 32768 THEN 'smallint' ELSE 'int' END FROM orders
    UNION ALL SELECT 'half', 'float' UNION ALL SELECT 'o_totalprice', CASE WHEN max((o_totalprice::FLOAT::DOUBLE <> o_totalprice)::INTEGER) = 1 THEN 'double' ELSE 'float' END FROM orders""")
def narrowest_types(read):
    rows = read("orders").select("o_orderkey", F.month("o_orderdate").alias("month"), (-F.col("o_custkey")).alias("negative"), (F.col("o_custkey") / 2).alias("half"), "o_totalprice", "o_orderstatus")
    return features.narrowest(rows)


_GAPS = "CASE WHEN o_orderkey % 5 > 0 THEN o_totalprice END"


@query(f"SELECT o_orderkey, coalesce({_GAPS}, (SELECT quantile_disc({_GAPS}, 0.5) FROM orders)) AS lower, coalesce({_GAPS}, (SELECT quantile_cont({_GAPS}, 0.5) FROM orders)) AS middle FROM orders")
def imputed_medians(read):
    gaps = F.when(F.col("o_orderkey") % 5 > 0, F.col("o_totalprice"))
    rows = read("orders").select("o_orderkey", gaps.alias("lower"), gaps.alias("middle"))
    return features.impute_medians(features.impute_medians(rows, ["lower"]), ["middle"], interpolated=True)


@query("SELECT c_custkey, c_mktsegment, round((SELECT count(*) FROM customer) / (k * n), 9) AS weight FROM customer JOIN (SELECT c_mktsegment, count(*) AS n, count(*) OVER () AS k FROM customer GROUP BY 1) USING (c_mktsegment)")
def balanced_weights(read):
    return rounded(relational.class_weights(read("customer").select("c_custkey", "c_mktsegment"), "c_mktsegment", balanced=True), weight=9)


@query("""
    WITH cells AS (SELECT o_orderkey, o_orderstatus AS target, CASE WHEN o_orderkey % 5 > 0 THEN o_custkey % 7 END AS seventh, CASE WHEN o_orderkey % 11 > 0 THEN o_orderpriority END AS priority FROM orders),
    targets AS (SELECT target, row_number() OVER (ORDER BY count(*) DESC, target) - 1 AS label FROM cells GROUP BY 1),
    priorities AS (SELECT priority, row_number() OVER (ORDER BY count(*) DESC, priority) - 1 AS k, count(*) OVER () AS n FROM cells WHERE priority IS NOT NULL GROUP BY 1),
    filled AS (SELECT o_orderkey, label, coalesce(seventh, (SELECT quantile_disc(seventh, 0.5) FROM cells)) AS seventh, coalesce(k, (SELECT max(n) FROM priorities)) AS k FROM cells JOIN targets USING (target) LEFT JOIN priorities USING (priority))
    SELECT o_orderkey, label::DOUBLE AS label, seventh::DOUBLE AS seventh, k::DOUBLE AS priority, array_to_string(list_concat([seventh::BIGINT], [(k = i)::BIGINT for i in range(0, (SELECT max(n) FROM priorities))]), ' ') AS features FROM filled""")
def encoded_features(read):
    """Index of the target, imputed number, index and one-hot code of a text, and their vector, by the model's own stages."""
    cells = read("orders").select("o_orderkey", F.col("o_orderstatus").alias("target"), F.when(F.col("o_orderkey") % 5 > 0, (F.col("o_custkey") % 7).cast("double")).alias("seventh"), F.when(F.col("o_orderkey") % 11 > 0, F.col("o_orderpriority")).alias("priority"))
    stages = model.label_pipeline(cells, ModelSpec(id_col="o_orderkey", target="target"))[0].getStages()[:-1]
    coded = Pipeline(stages=stages).fit(cells).transform(cells)
    vector = F.array_join(F.transform(vector_to_array("__features"), lambda x: x.cast("int").cast("string")), " ")
    return coded.select("o_orderkey", F.col("__label").alias("label"), F.col("seventh__imputed").alias("seventh"), F.col("priority__indexed").alias("priority"), vector.alias("features"))


def _standardised(read) -> DataFrame:
    rows = VectorAssembler(inputCols=["o_totalprice", "o_custkey"], outputCol="features").transform(read("orders"))
    return StandardScaler(inputCol="features", outputCol="std_features").fit(rows).transform(rows)


@query("SELECT o_orderkey, round(o_totalprice / (SELECT stddev_samp(o_totalprice) FROM orders), 6) AS price, round(o_custkey / (SELECT stddev_samp(o_custkey) FROM orders), 6) AS customer FROM orders")
def standardised(read):
    cells = vector_to_array("std_features")
    return _standardised(read).select("o_orderkey", F.round(cells[0], 6).alias("price"), F.round(cells[1], 6).alias("customer"))


@query("SELECT round((1 + abs(corr(o_totalprice, o_custkey))) / 2, 6) AS first, CASE WHEN (1 + abs(corr(o_totalprice, o_custkey))) / 2 > 0.5 THEN 1 ELSE 2 END AS half, 2 AS most, 'std_features' AS beyond FROM orders")
def principal_components(read):
    """The first component's share, how many components exceed half and nine tenths of the variance, and the input where none do."""
    rows = _standardised(read).select("std_features")
    share = float(PCA(k=2, inputCol="std_features", outputCol="pca").fit(rows).explainedVariance[0])
    sizes = [len(sampling.pca_features(rows, 2, least)[0].select("pca").first().pca) for least in (0.5, 0.9)]
    return rows.sparkSession.createDataFrame([(round(share, 6), *sizes, sampling.pca_features(rows, 1, 0.99)[1])], "first double, half int, most int, beyond string")


# Samples


def draw_sql(seed: int, *keys: str) -> str:
    return f"(('0x' || substr(md5(concat_ws('|', '{seed}', {', '.join(f'{k}::VARCHAR' for k in keys)})), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE)"


@query(f"SELECT event_id, event_type FROM events WHERE {draw_sql(42, 'event_id')} < 0.1")
def stratified_sample(read):
    return sampling.stratified_sample(read("events"), "event_type", 0.1, 42, ["event_id"]).select("event_id", "event_type")


@query(f"SELECT event_id, event_type FROM events WHERE {draw_sql(7, 'event_id')} < CASE event_type WHEN 'click' THEN 0.5 WHEN 'view' THEN 0.05 ELSE 0 END")
def sample_by_share(read):
    return sampling.stratified_sample(read("events"), "event_type", {"click": 0.5, "view": 0.05}, 7, ["event_id"]).select("event_id", "event_type")


@query(f"SELECT event_id FROM events WHERE {draw_sql(3, 'event_id')} < 500.0 / (SELECT count(*) FROM events)")
def sample_of_a_size(read):
    return sampling.uniform_sample(read("events"), 500, 3, ["event_id"]).select("event_id")


def _in_parts(train: DataFrame, test: DataFrame) -> DataFrame:
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test"))).select("event_id", "event_type", "part")


@query(f"SELECT event_id, event_type, CASE WHEN {draw_sql(0, 'event_id')} < 0.2 THEN 'test' ELSE 'train' END AS part FROM events")
def train_test_split(read):
    return _in_parts(*sampling.stratified_train_test_split(read("events"), "event_type", 0.2, 0, ["event_id"]))


@query(f"WITH drawn AS (SELECT event_id, event_type, {draw_sql(0, 'event_id')} AS draw FROM events) SELECT event_id, event_type, CASE WHEN draw <= cut THEN 'test' ELSE 'train' END AS part FROM drawn JOIN (SELECT event_type, quantile_disc(draw, 0.2) AS cut FROM drawn GROUP BY 1) USING (event_type)")
def exact_test_split(read):
    return _in_parts(*sampling.exact_test_split(read("events"), "event_type", 0.2, 0, ["event_id"]))


@query(f"WITH drawn AS (SELECT event_id, event_type, {draw_sql(1, 'event_id')} AS draw FROM events) SELECT event_id, (draw > a)::INTEGER + (draw > b)::INTEGER AS fold FROM drawn JOIN (SELECT event_type, quantile_disc(draw, 1 / 3) AS a, quantile_disc(draw, 2 / 3) AS b FROM drawn GROUP BY 1) USING (event_type)")
def stratified_folds(read):
    return sampling.stratified_folds(read("events"), "event_type", 3, 1, ["event_id"]).select("event_id", "fold")


@query("SELECT o_orderstatus, max(count(*)) OVER () AS n, max(count(*)) OVER () - count(*) AS n_synthetic, TRUE AS inside FROM orders GROUP BY 1")
def oversampled(read):
    """Every class as large as the largest, and synthetic rows within their class's range."""
    rows = read("orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_custkey")
    made = sampling.oversample(rows, "o_orderstatus", ["o_totalprice", "o_custkey"], ["o_orderkey"])
    ends = rows.groupBy("o_orderstatus").agg(*(f(c).cast("double").alias(f"{n}_{c}") for c in ("o_totalprice", "o_custkey") for n, f in (("low", F.min), ("high", F.max))))
    inside = F.col("o_totalprice").between(F.col("low_o_totalprice"), F.col("high_o_totalprice")) & F.col("o_custkey").between(F.col("low_o_custkey"), F.col("high_o_custkey"))
    return made.join(F.broadcast(ends), "o_orderstatus").groupBy("o_orderstatus").agg(F.count("*").alias("n"), F.sum(F.col("synthetic").cast("long")).alias("n_synthetic"), F.min(inside).alias("inside"))  # a row to a class


@query(f"SELECT l_orderkey, l_linenumber, TRUE AS clustered FROM lineitem WHERE {draw_sql(42, 'l_orderkey', 'l_linenumber')} < 1000.0 / (SELECT count(*) FROM lineitem)")
def kmeans_sample(read):
    names = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    drawn = sampling.kmeans_sample(read("lineitem"), names, 1000, 6, 0.8, (4, 0.9), 42, ["l_orderkey", "l_linenumber"])
    return drawn.select("l_orderkey", "l_linenumber", F.col("prediction").between(0, 4).alias("clustered"))


@query(f"SELECT l_orderkey, l_linenumber, TRUE AS predicted FROM lineitem WHERE {draw_sql(42, 'l_orderkey', 'l_linenumber')} < 1000.0 / (SELECT count(*) FROM lineitem)")
def dtree_sample(read):
    drawn = sampling.dtree_sample(read("lineitem"), ["l_quantity", "l_extendedprice", "l_discount"], "l_returnflag", 1000, 1000, 42, ["l_orderkey", "l_linenumber"])
    return drawn.select("l_orderkey", "l_linenumber", F.col("prediction").isin(0.0, 1.0, 2.0).alias("predicted"))


# Models

_SMALL = ModelSpec(id_col="doc_id", target="quality", depths=(3, 5), min_instances=(10,), trees=(10,))
_UNLABELLED = "FROM documents LEFT JOIN labels USING (doc_id) WHERE quality IS NULL"


def _documents_to_label(read) -> DataFrame:
    marks = F.length(F.regexp_replace("text", "[^!#$%&*]", ""))
    docs = read("documents").select("doc_id", "lang", "source", "n_chars", marks.alias("marks"))
    return docs.join(read("labels").select("doc_id", F.col("quality").cast("string").alias("quality")), "doc_id", "left")


@query(f"SELECT doc_id, TRUE AS known, TRUE AS right_side {_UNLABELLED}")
def label_model(read):
    """Every unlabelled row once, with a label of the training rows, on the side that its probability puts it."""
    sure, rest, fitted = model.label_by_model(_documents_to_label(read), _SMALL)
    again = model.predict_labels(_documents_to_label(read), fitted.model, _SMALL).select("doc_id", "max_prob", F.col("target_max_prob").alias("again"))
    both = sure.select("doc_id", "quality", F.lit(True).alias("sure")).unionByName(rest.select("doc_id", F.col("target_max_prob").alias("quality"), F.lit(False).alias("sure")))
    joined = both.join(again, "doc_id")
    return joined.select("doc_id", (F.col("quality").isin("0", "1") & (F.col("quality") == F.col("again"))).alias("known"), ((F.col("max_prob") >= 0.6) == F.col("sure")).alias("right_side"))


@query(f"SELECT count(*) AS scored, 0 AS differing, TRUE AS accurate {_UNLABELLED}")
def saved_model(read):
    """A model fitted by hold-out over stratified classes, saved and loaded, predicts what it predicted."""
    rows = materialise(_documents_to_label(read), "to_label")
    spec = ModelSpec(id_col="doc_id", target="quality", test_share=0.3, weighted=True, balanced=True)
    fitted = model.fit_labels(rows, spec)
    path = scratch_path(rows.sparkSession, "model")
    save_model(fitted.model, path)
    one, two = (model.predict_labels(rows, m, spec).select("doc_id", F.col("target_max_prob").alias(n), F.col("max_prob").alias(f"{n}_prob")) for m, n in ((fitted.model, "before"), (load_model(path), "after")))
    same = (F.col("before") == F.col("after")) & (F.abs(F.col("before_prob") - F.col("after_prob")) < 1e-9)
    return one.join(two, "doc_id").agg(F.count("*").alias("scored"), F.sum((~same).cast("int")).cast("int").alias("differing")).withColumn("accurate", F.lit(bool(fitted.metrics["accuracy"] > 0.6 and fitted.metrics["f1"] > 0.6)))


# The labelling pipeline

_NAME_SQL = "array_to_string(string_split(text, ' ')[1:6], ' ')"
_LABELLING = f"""
    WITH named AS (SELECT doc_id, {_NAME_SQL} AS name, lang, source, n_chars FROM documents),
    register0 AS (
        SELECT DISTINCT name AS idbr_name, CASE lang WHEN 'en' THEN 'S14' WHEN 'de' THEN 'S121' WHEN 'fr' THEN 'S124' END AS esa FROM named
        WHERE doc_id % 2 = 0 AND doc_id % 7 > 0 AND lang <> 'es'),
    register1 AS (SELECT * FROM register0 QUALIFY count(*) OVER (PARTITION BY idbr_name) = 1),
    owners0 AS (
        SELECT doc_id AS id, name, lang, source, n_chars FROM named WHERE doc_id % 2 = 1
        UNION ALL SELECT CASE WHEN doc_id % 30 = 0 THEN doc_id + 1 ELSE doc_id + 10000000 END, 'The and ' || name, lang, source, n_chars FROM named WHERE doc_id % 10 = 0),
    scope AS (SELECT id::VARCHAR AS Owner_ID, name AS Owner_Name, CASE WHEN id % 9 > 0 THEN source END AS URL, lang AS Owner_Type, n_chars AS value FROM owners0, (VALUES (1), (2)) twice(k) WHERE id % 11 > 0),
    complete AS (SELECT * FROM (SELECT DISTINCT Owner_ID, Owner_Name, URL, Owner_Type FROM scope WHERE URL IS NOT NULL) QUALIFY count(*) OVER (PARTITION BY Owner_ID) = 1),
    repeated AS (SELECT Owner_ID FROM (SELECT DISTINCT Owner_ID, Owner_Name FROM scope WHERE URL IS NOT NULL) QUALIFY count(*) OVER (PARTITION BY Owner_ID) > 1),
    clean AS (SELECT * FROM scope WHERE Owner_ID IN (SELECT Owner_ID FROM complete)),
    totals AS (SELECT Owner_ID, sum(value) AS total FROM clean GROUP BY 1),
    players AS (SELECT Owner_ID FROM totals QUALIFY rank() OVER (ORDER BY total DESC) <= 10),
    others AS (SELECT * FROM clean WHERE Owner_ID NOT IN (SELECT Owner_ID FROM players)),
    owners1 AS (SELECT * FROM (SELECT DISTINCT Owner_ID, Owner_Name FROM others) QUALIFY count(*) OVER (PARTITION BY Owner_Name) = 1),
    {pass_sql(1, EXACT, 0)},
    register2 AS (SELECT * FROM register1 WHERE idbr_name NOT IN (SELECT idbr_name FROM found1)),
    owners2 AS (SELECT * FROM owners1 WHERE Owner_ID NOT IN (SELECT Owner_ID FROM found1)),
    {pass_sql(2, LOOSE, 3)},
    labels AS (SELECT Owner_ID, esa FROM found1 UNION ALL SELECT Owner_ID, esa FROM found2)"""


def _staged(read) -> tuple[DataFrame, DataFrame]:
    """A register of even documents and holdings of odd ones, under their first words as names."""
    docs = read("documents").withColumn("name", F.substring_index("text", " ", 6))
    code = F.when(F.col("lang") == "en", "xS14").when(F.col("lang") == "de", "S121").when(F.col("lang") == "fr", "S124 S14").otherwise("none")
    died = F.when(F.col("doc_id") % 7 == 0, F.lit("2015-12-31")).when(F.col("doc_id") % 5 == 0, F.lit("2016-01-02")).cast("date")
    register = docs.where("doc_id % 2 = 0").select(F.col("doc_id").cast("string").alias("id"), F.col("name").alias("idbr_name"), code.alias("esa"), died.alias("death_date"))
    renamed = docs.where("doc_id % 10 = 0").withColumns({"doc_id": F.col("doc_id") + F.when(F.col("doc_id") % 30 == 0, 1).otherwise(10_000_000), "name": F.concat(F.lit("The and "), "name")})
    owners = docs.where("doc_id % 2 = 1").unionByName(renamed)
    kind: Column = F.when(F.col("doc_id") % 11 == 0, "Individual Investor").otherwise(F.col("lang"))
    dates = F.explode(F.array(*map(F.lit, ("2016-06-30", "2017-06-30", "2018-01-01"))))
    holdings = owners.select(F.col("doc_id").cast("string").alias("Owner_ID"), F.col("name").alias("Owner_Name"), F.when(F.col("doc_id") % 9 > 0, F.col("source")).alias("URL"), kind.alias("Owner_Type"), F.lit("1").alias("Owner_Country_ID"), dates.alias("Report_Date"), F.col("n_chars").cast("string").alias("Value_Held"), "lang")
    return register, holdings


@query(_LABELLING + " SELECT * FROM labels")
def labels_by_name(read):
    return pipeline.label_by_name(*_staged(read))["labels"]


_PIPELINE = pipeline.PipelineSpec(
    features=FeatureSpec(static_categorical=("Owner_Type",), static_numerical=(), dynamic_categorical=("lang",), dynamic_numerical=("Value_Held",), fold_labels_below=2),
    model=ModelSpec(depths=(3,), min_instances=(1,), trees=(5,), folds=2),
)


@query(_LABELLING + """
    SELECT 'labels' AS name, count(*) AS n FROM labels UNION ALL SELECT 'bp', count(*) FROM players UNION ALL SELECT 'tr', count(*) FROM others
    UNION ALL SELECT 'ids_dups', count(*) FROM repeated UNION ALL SELECT 'idbr', count(*) FROM register2 WHERE idbr_name NOT IN (SELECT idbr_name FROM found2)
    UNION ALL SELECT 'df', count(DISTINCT Owner_ID) FROM others UNION ALL SELECT 'predicted', count(DISTINCT Owner_ID) FROM others WHERE Owner_ID NOT IN (SELECT Owner_ID FROM labels)
    UNION ALL SELECT 'manual_left', 0""")
def labelling_pipeline(read):
    """The whole pipeline over staged files: rows of each table; what the model leaves is all recommended for or not."""
    register, holdings = _staged(read)
    folder = scratch_path(register.sparkSession, "labelling")
    register.write.parquet(f"{folder}/register")
    holdings.write.parquet(f"{folder}/holdings")
    made = pipeline.run(register.sparkSession, folder, _PIPELINE)
    n = {k: df.count() for k, df in made.items()}
    owners = made["manual_labels"].select("Owner_ID")
    left = owners.join(made["mlabels_rm"], "Owner_ID", "left_anti").join(made["mlabels_no_rm"], "Owner_ID", "left_anti").count()
    rows = [(k, n[k]) for k in ("labels", "bp", "tr", "ids_dups", "idbr", "df")] + [("predicted", n["ml_labels"] + n["manual_labels"]), ("manual_left", left)]
    return register.sparkSession.createDataFrame(rows, "name string, n long")


_STREAM = f"""
    WITH register1 AS (SELECT {_NAME_SQL} AS idbr_name, lang AS esa FROM documents WHERE doc_id % 2 = 0),
    owners1 AS (SELECT doc_id AS Owner_ID, {_NAME_SQL} || ' 17' AS Owner_Name FROM documents WHERE doc_id % 4 < 2),
    {pass_sql(1, EXACT, 0)}"""


@query(_STREAM + f" SELECT o.Owner_ID, idbr_name, esa FROM (SELECT Owner_ID, {normalised_sql('Owner_Name', EXACT)} AS name_ FROM owners1) o JOIN right1 USING (name_)")
def linked_stream(read):
    """Owners that come as a stream of files, against a standing register."""
    docs = read("documents").withColumn("name", F.substring_index("text", " ", 6))
    spark = docs.sparkSession
    register = docs.where("doc_id % 2 = 0").select(F.col("name").alias("idbr_name"), F.col("lang").alias("esa"))
    owners = docs.where("doc_id % 4 < 2").select(F.col("doc_id").alias("Owner_ID"), F.concat("name", F.lit(" 17")).alias("Owner_Name"))
    folder = scratch_path(spark, "stream")
    owners.repartition(4).write.parquet(f"{folder}/in")
    stream = spark.readStream.schema(owners.schema).option("maxFilesPerTrigger", 2).parquet(f"{folder}/in")
    found = link_stream(stream, register).select("Owner_ID", "idbr_name", "esa")
    found.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(found.schema).parquet(f"{folder}/out")
