"""Selection, scalar functions, joins, ordering and reshaping over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from labelworks.functions import scalar as S
from labelworks.operators import select as O
from labelworks.operators import split as P
from workload.registry import query
from workload.tables import LONG_SQL, MODELS, PEOPLE_SQL, TITLE_SQL, WIDE_SQL, people, raw_scores, read, six, wide

# --- sources and previews ---


@query("preview", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 5")
def preview(spark, sf):
    orders = read(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    return O.preview(orders, "o_orderkey")


# --- projections and filters ---


@query("drop_columns", "SELECT c_custkey, c_nationkey, c_acctbal FROM customer")
def drop_columns(spark, sf):
    return O.drop_columns(read(spark, sf, "customer"), ["c_name", "c_mktsegment"])


@query("split_target", "SELECT doc_id, quality AS label, toxic FROM labels")
def split_target(spark, sf):
    return O.split_target(read(spark, sf, "labels"), "quality")


@query("select_columns", "SELECT l_returnflag, l_quantity FROM lineitem")
def select_columns(spark, sf):
    return O.select_columns(read(spark, sf, "lineitem"), ["l_returnflag", "l_quantity"])


@query("filter_missing", f"WITH {PEOPLE_SQL} SELECT c_custkey, full_name FROM people WHERE balance IS NULL")
def filter_missing(spark, sf):
    return O.filter_missing(people(spark, sf), "balance").select("c_custkey", "full_name")


@query("constant_column", "SELECT p_partkey, 'baseline' AS model FROM part")
def constant_column(spark, sf):
    return O.constant_column(read(spark, sf, "part").select("p_partkey"), "model", "baseline")


@query(
    "distinct_values",
    "SELECT p_brand, min(p_partkey) AS first_key FROM part GROUP BY p_brand ORDER BY first_key LIMIT 5",
)
def distinct_values(spark, sf):
    return O.distinct_values(read(spark, sf, "part"), "p_brand", "p_partkey", 5)


@query("threshold", f"WITH {WIDE_SQL} SELECT row_id, CASE WHEN m1 >= 0.98 THEN 1 ELSE 0 END AS pred FROM wide")
def threshold(spark, sf):
    return wide(spark, sf).select("row_id", S.threshold("m1", 0.98).alias("pred"))


FAMILY_SQL = "SELECT p_brand AS model, round(avg(p_retailprice), 6) AS score FROM part GROUP BY p_brand"


@query("exclude_named", f"SELECT * FROM ({FAMILY_SQL}) WHERE model <> 'Brand#7'")
def exclude_named(spark, sf):
    rows = read(spark, sf, "part").groupBy(F.col("p_brand").alias("model")).agg(F.round(F.avg("p_retailprice"), 6).alias("score"))
    return O.exclude_named(rows, "model", "Brand#7")


@query(
    "list_columns",
    f"""WITH {PEOPLE_SQL}
SELECT * FROM (VALUES ('c_custkey', 1, 'bigint'), ('c_nationkey', 2, 'int'), ('c_mktsegment', 3, 'string'),
  ('full_name', 4, 'string'), ('balance', 5, 'double'), ('code', 6, 'string')) AS t("column", position, type)
JOIN (UNPIVOT (SELECT count(c_custkey) AS c_custkey, count(c_nationkey) AS c_nationkey, count(c_mktsegment) AS c_mktsegment,
  count(full_name) AS full_name, count(balance) AS balance, count(code) AS code FROM people)
  ON c_custkey, c_nationkey, c_mktsegment, full_name, balance, code INTO NAME "column" VALUE non_null) USING ("column")""",
)
def list_columns(spark, sf):
    return O.list_columns(people(spark, sf))


# --- scalar functions ---


@query("extract_title", f"WITH {PEOPLE_SQL} SELECT c_custkey, {TITLE_SQL} AS title FROM people")
def extract_title(spark, sf):
    return people(spark, sf).select("c_custkey", S.extract_title("full_name").alias("title"))


@query("first_char", f"WITH {PEOPLE_SQL} SELECT c_custkey, nullif(substring(code, 1, 1), '') AS cabin_name FROM people")
def first_char(spark, sf):
    return people(spark, sf).select("c_custkey", S.first_char("code").alias("cabin_name"))


@query(
    "deck_or_unknown",
    f"WITH {PEOPLE_SQL} SELECT c_custkey, coalesce(nullif(substring(code, 1, 1), ''), 'Unknown') AS deck FROM people",
)
def deck_or_unknown(spark, sf):
    return people(spark, sf).select("c_custkey", S.deck_or_unknown("code").alias("deck"))


@query(
    "regex_prefix",
    "SELECT o_orderkey, regexp_extract(o_orderpriority, '^([^0-9]*)', 1) AS digits_first, "
    "regexp_extract(concat(o_orderstatus, o_orderpriority), '^([^0-9]*)', 1) AS prefix FROM orders",
)
def regex_prefix(spark, sf):
    both = F.concat("o_orderstatus", "o_orderpriority")
    return read(spark, sf, "orders").select(
        "o_orderkey", S.regex_prefix("o_orderpriority").alias("digits_first"), S.regex_prefix(both).alias("prefix")
    )


# The edges and names of the fare bins.
BIN_SQL = """CASE WHEN value > 0 AND value <= 7.91 THEN 'low' WHEN value > 7.91 AND value <= 14.45 THEN 'medium-low'
  WHEN value > 14.45 AND value <= 31 THEN 'medium-high' WHEN value > 31 AND value <= 250.5 THEN 'high' END"""


def value_bin():
    # Fixed values, as above.
    return S.bin_fixed("value", [0, 7.91, 14.45, 31, 250.5], ["low", "medium-low", "medium-high", "high"])


@query("bin_fixed", f"SELECT event_id, {BIN_SQL} AS value_binned FROM events")
def bin_fixed(spark, sf):
    return read(spark, sf, "events").select("event_id", value_bin().alias("value_binned"))


@query(
    "sigmoid_clipped",
    "SELECT c_custkey, round(1 / (1 + exp(-greatest(-50, least(50, c_acctbal / 100)))), 6) AS p FROM customer",
)
def sigmoid_clipped(spark, sf):
    return read(spark, sf, "customer").select("c_custkey", F.round(S.sigmoid_clipped(F.col("c_acctbal") / 100), 6).alias("p"))


@query("cast_types", "SELECT event_id, CAST(trunc(value) AS INTEGER) AS whole, CAST(user_id AS DOUBLE) AS user_score FROM events")
def cast_types(spark, sf):
    return read(spark, sf, "events").select(
        "event_id", S.cast_int("value").alias("whole"), S.cast_float("user_id").alias("user_score")
    )


@query("weighted_sum", f"WITH {WIDE_SQL} SELECT row_id, round(0.33 * m1 + 0.33 * m2 + 0.34 * m3, 6) AS blend FROM wide")
def weighted_sum(spark, sf):
    return wide(spark, sf).select("row_id", F.round(S.weighted_sum(MODELS, [0.33, 0.33, 0.34]), 6).alias("blend"))


@query("abs_mean", f"WITH {LONG_SQL} SELECT model, round(avg(abs(score)), 6) AS mean_abs FROM raw_scores GROUP BY model")
def abs_mean(spark, sf):
    return raw_scores(spark, sf).groupBy("model").agg(F.round(S.abs_mean("score"), 6).alias("mean_abs"))


@query("metric_key", "SELECT doc_id, lang || '/' || source AS key FROM documents")
def metric_key(spark, sf):
    return read(spark, sf, "documents").select("doc_id", S.metric_key("lang", "source").alias("key"))


@query(
    "coalesce_fill",
    f"""WITH {PEOPLE_SQL}, titled AS (SELECT *, {TITLE_SQL} AS title FROM people)
SELECT c_custkey, round(coalesce(balance, m.med, (SELECT median(balance) FROM titled)), 6) AS balance
FROM titled LEFT JOIN (SELECT title, median(balance) AS med FROM titled GROUP BY title) m USING (title)""",
)
def coalesce_fill(spark, sf):
    from labelworks.operators.quantiles import global_median, group_median

    titled = people(spark, sf).withColumn("title", S.extract_title("full_name"))
    medians = group_median(titled, "title", "balance", "title_median")
    joined = O.lookup_join(titled, medians, "title").withColumn("all_median", global_median(titled, "balance").scalar())
    filled = S.coalesce_fill("balance", "title_median", "all_median")
    return joined.select("c_custkey", F.round(filled, 6).alias("balance"))


# --- joins by key ---


@query(
    "lookup_join",
    f"""WITH {PEOPLE_SQL}, titled AS (SELECT c_custkey, balance, {TITLE_SQL} AS title FROM people)
SELECT c_custkey, title, n_balances FROM titled
LEFT JOIN (SELECT title, count(*) AS n_balances FROM titled WHERE balance IS NOT NULL GROUP BY title) USING (title)""",
)
def lookup_join(spark, sf):
    titled = people(spark, sf).select("c_custkey", "balance", S.extract_title("full_name").alias("title"))
    lookup = titled.where(F.col("balance").isNotNull()).groupBy("title").agg(F.count(F.lit(1)).alias("n_balances"))
    return O.lookup_join(titled.drop("balance"), lookup, "title")


@query("align_scores", f"WITH {WIDE_SQL} SELECT row_id, round(m1, 6) AS m1, round(m2, 6) AS m2, round(m3, 6) AS m3 FROM wide")
def align_scores(spark, sf):
    long = raw_scores(spark, sf)
    frames = {m: long.where(F.col("model") == m) for m in MODELS}
    return O.align_scores(frames, "row_id", "score").select("row_id", *[six(m) for m in MODELS])


@query("label_join", "SELECT doc_id, n_chars, quality FROM documents JOIN labels USING (doc_id)")
def label_join(spark, sf):
    documents = read(spark, sf, "documents").select("doc_id", "n_chars")
    return O.label_join(documents, read(spark, sf, "labels"), "doc_id", "quality")


@query("missing_names", "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def missing_names(spark, sf):
    return O.missing_names(read(spark, sf, "documents").select("doc_id"), read(spark, sf, "labels"), "doc_id")


LISTS_SQL = """brands AS (SELECT DISTINCT p_brand AS v FROM part), types AS (SELECT DISTINCT p_type AS v FROM part),
flags AS (SELECT DISTINCT l_returnflag AS v FROM lineitem),
grid AS (
  SELECT row_number() OVER (ORDER BY brands.v, types.v, flags.v) - 1 AS point, brands.v AS brand, types.v AS type, flags.v AS flag
  FROM brands, types, flags)"""


def found_grid(spark, sf):
    """Grid over the values found in the tables; the texts are JSON, so their quotes come off."""
    part = P.distinct_lists(read(spark, sf, "part"), ["p_brand", "p_type"])
    flags = P.distinct_lists(read(spark, sf, "lineitem"), ["l_returnflag"])
    space = {"brand": part["p_brand"], "type": part["p_type"], "flag": flags["l_returnflag"]}
    grid = P.parameter_grid(spark, space)
    return grid.select("point", *[F.from_json(F.concat(F.lit('{"v":'), c, F.lit("}")), "v string")["v"].alias(c) for c in space])


@query("model_param_cross", f"WITH {LISTS_SQL} SELECT brand, type, flag FROM grid")
def model_param_cross(spark, sf):
    part, line = read(spark, sf, "part"), read(spark, sf, "lineitem")
    lists = {"type": P.distinct_lists(part, ["p_type"])["p_type"], "flag": P.distinct_lists(line, ["l_returnflag"])["l_returnflag"]}
    return P.param_cross(part.select(F.col("p_brand").alias("brand")).distinct(), lists)


@query("parameter_grid", f"WITH {LISTS_SQL} SELECT * FROM grid")
def parameter_grid(spark, sf):
    return found_grid(spark, sf)


@query("parameter_sample", f"WITH {LISTS_SQL} SELECT * FROM grid ORDER BY md5(concat('42|', point)), point LIMIT 20")
def parameter_sample(spark, sf):
    return P.parameter_sample(found_grid(spark, sf), 20)


# --- ordering ---

VALUE_SQL = "SELECT p_brand AS feature, round(avg(p_retailprice * p_size), 6) AS importance FROM part GROUP BY p_brand"


def brand_values(spark, sf):
    worth = F.round(F.avg(F.col("p_retailprice") * F.col("p_size")), 6)
    return read(spark, sf, "part").groupBy(F.col("p_brand").alias("feature")).agg(worth.alias("importance"))


@query("sort_desc", f"{VALUE_SQL} ORDER BY importance DESC, feature")
def sort_desc(spark, sf):
    return O.sort_desc(brand_values(spark, sf), "importance", "feature")


@query("sort_by_name", f"{VALUE_SQL} ORDER BY feature")
def sort_by_name(spark, sf):
    return O.sort_by_name(brand_values(spark, sf), "feature")


@query("top_k", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def top_k(spark, sf):
    return O.top_k(read(spark, sf, "orders").select("o_orderkey", "o_totalprice"), "o_totalprice", "o_orderkey", 20)


@query(
    "top_k_per_group",
    """SELECT p_brand, p_partkey, p_retailprice FROM (SELECT *, row_number() OVER (PARTITION BY p_brand
ORDER BY p_retailprice DESC, p_partkey) AS rn FROM part) WHERE rn <= 10""",
)
def top_k_per_group(spark, sf):
    part = read(spark, sf, "part").select("p_brand", "p_partkey", "p_retailprice")
    return O.top_k(part, "p_retailprice", "p_partkey", 10, ["p_brand"])


# --- reshaping ---


@query(
    "union_rows",
    """SELECT s_name AS name, s_acctbal AS balance, CAST(NULL AS VARCHAR) AS segment FROM supplier
UNION ALL SELECT c_name, c_acctbal, c_mktsegment FROM customer""",
)
def union_rows(spark, sf):
    suppliers = read(spark, sf, "supplier").select(F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    customers = read(spark, sf, "customer").select(
        F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment")
    )
    return O.union_rows(suppliers, customers)


@query("stack_scores", f"WITH {LONG_SQL} SELECT row_id, model, round(score, 6) AS score FROM raw_scores")
def stack_scores(spark, sf):
    return raw_scores(spark, sf).select("row_id", "model", six("score"))


@query(
    "dict_to_rows",
    """SELECT p_partkey, unnest(['brand', 'size', 'type']) AS parameter,
unnest([p_brand, CAST(p_size AS VARCHAR), p_type]) AS value FROM part""",
)
def dict_to_rows(spark, sf):
    settings = F.create_map(
        F.lit("size"), F.col("p_size").cast("string"), F.lit("brand"), F.col("p_brand"), F.lit("type"), F.col("p_type")
    )
    return O.dict_to_rows(read(spark, sf, "part").select("p_partkey", settings.alias("settings")), "settings", ["p_partkey"])
