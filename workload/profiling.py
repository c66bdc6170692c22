"""Profiles of the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from labelworks.functions import scalar as S
from labelworks.operators import order as W
from labelworks.operators import profile as E
from labelworks.operators import quantiles as Q
from labelworks.operators import states as M
from labelworks.operators.keep import keep
from workload.registry import query
from workload.shape import BIN_SQL, value_bin
from workload.tables import LONG_SQL, PEOPLE_SQL, TITLE_SQL, people, raw_scores, read, six

TITLED_SQL = f"{PEOPLE_SQL}, titled AS (SELECT *, {TITLE_SQL} AS title FROM people)"


def titled(spark, sf):
    return people(spark, sf).withColumn("title", S.extract_title("full_name"))


@query("group_median", f"WITH {TITLED_SQL} SELECT title, round(median(balance), 6) AS balance FROM titled GROUP BY title")
def group_median(spark, sf):
    return Q.group_median(titled(spark, sf), "title", "balance", "balance").select("title", six("balance"))


@query("global_median", "SELECT round(median(l_extendedprice), 6) AS median FROM lineitem")
def global_median(spark, sf):
    return Q.global_median(read(spark, sf, "lineitem"), "l_extendedprice").select(six("median"))


@query(
    "mode_value",
    """SELECT 'l_returnflag' AS "column", (SELECT l_returnflag FROM lineitem GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS mode
UNION ALL SELECT 'l_linestatus', (SELECT l_linestatus FROM lineitem GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)""",
)
def mode_value(spark, sf):
    return E.mode_value(read(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus"])


@query(
    "nunique_all",
    """UNPIVOT (SELECT count(DISTINCT o_orderkey) AS o_orderkey, count(DISTINCT o_custkey) AS o_custkey,
count(DISTINCT o_orderstatus) AS o_orderstatus, count(DISTINCT o_totalprice) AS o_totalprice,
count(DISTINCT o_orderdate) AS o_orderdate, count(DISTINCT o_orderpriority) AS o_orderpriority FROM orders)
ON COLUMNS(*) INTO NAME "column" VALUE n_unique""",
)
def nunique_all(spark, sf):
    return E.nunique_all(read(spark, sf, "orders"))


@query("value_counts", "SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1 ORDER BY n DESC, 1")
def value_counts(spark, sf):
    return E.value_counts(read(spark, sf, "orders"), "o_orderpriority")


@query(
    "grouped_value_counts",
    "SELECT o_orderpriority, o_orderstatus, count(*) AS n FROM orders GROUP BY 1, 2 ORDER BY 1, n DESC, 2",
)
def grouped_value_counts(spark, sf):
    return E.grouped_value_counts(read(spark, sf, "orders"), "o_orderpriority", "o_orderstatus")


@query("count_by_hue", "SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY 1, 2")
def count_by_hue(spark, sf):
    return E.count_by_hue(read(spark, sf, "lineitem"), "l_returnflag", "l_linestatus")


CROSS_SQL = """SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'F') AS n_F, count(*) FILTER (o_orderstatus = 'O') AS n_O,
count(*) FILTER (o_orderstatus = 'P') AS n_P FROM orders GROUP BY 1"""


@query("crosstab", CROSS_SQL)
def crosstab(spark, sf):
    return E.crosstab(read(spark, sf, "orders"), "o_orderpriority", "o_orderstatus", ["F", "O", "P"])


@query(
    "crosstab_rate",
    f"""SELECT o_orderpriority, round(n_F / (n_F + n_O + n_P), 6) AS "rate_F", round(n_O / (n_F + n_O + n_P), 6) AS "rate_O",
round(n_P / (n_F + n_O + n_P), 6) AS "rate_P" FROM ({CROSS_SQL})""",
)
def crosstab_rate(spark, sf):
    rates = E.crosstab_rate(read(spark, sf, "orders"), "o_orderpriority", "o_orderstatus", ["F", "O", "P"])
    return rates.select("o_orderpriority", *[six(c) for c in rates.columns[1:]])


@query(
    "binned_crosstab_rate",
    f"""SELECT value_binned, round(avg(CASE WHEN event_type = 'purchase' THEN 0.0 ELSE 1.0 END), 6) AS rate_0,
round(avg(CASE WHEN event_type = 'purchase' THEN 1.0 ELSE 0.0 END), 6) AS rate_1
FROM (SELECT *, {BIN_SQL} AS value_binned FROM events) WHERE value_binned IS NOT NULL GROUP BY 1""",
)
def binned_crosstab_rate(spark, sf):
    bought = F.when(F.col("event_type") == "purchase", 1).otherwise(0).alias("bought")
    binned = read(spark, sf, "events").select(value_bin().alias("value_binned"), bought)
    rates = E.crosstab_rate(binned, "value_binned", "bought", [0, 1])
    return rates.select("value_binned", six("rate_0"), six("rate_1"))


def _describe_sql(table: str, column: str, by: str = "") -> str:
    head = f"{by}, " if by else ""
    tail = f"GROUP BY {by}" if by else ""
    return f"""SELECT {head}'{column}' AS "column", count({column}) AS n, round(avg({column}), 6) AS mean,
round(stddev_samp({column}), 6) AS std, round(CAST(min({column}) AS DOUBLE), 6) AS min, round(CAST(max({column}) AS DOUBLE), 6) AS max,
round(quantile_cont({column}, 0.25), 6) AS q25, round(quantile_cont({column}, 0.5), 6) AS q50,
round(quantile_cont({column}, 0.75), 6) AS q75 FROM {table} {tail}"""


NUMBERS = ("n", "mean", "std", "min", "max", "q25", "q50", "q75")


@query(
    "describe_numeric",
    " UNION ALL ".join(_describe_sql("lineitem", c) for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")),
)
def describe_numeric(spark, sf):
    out = E.describe_numeric(read(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])
    return out.select("column", "n", *[six(c) for c in NUMBERS[1:]])


PRICED = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "profile_states",
    f"""SELECT "column", n, round(mean, 4) AS mean, round(std, 4) AS std, min, max, q25, q50, q75
FROM ({" UNION ALL ".join(_describe_sql("lineitem", c) for c in PRICED)})""",
)
def profile_states(spark, sf):
    """The same facts from the states of three parts, merged; the quartiles from the merged brackets."""
    table = read(spark, sf, "lineitem")
    parts = [table.where(F.col("l_orderkey") % 3 == i) for i in range(3)]
    state = keep(M.merge_states(*[M.profile_state(p, PRICED) for p in parts]))
    quartiles = E.quartile_columns(M.quantiles_from_state(table, state, PRICED, list(E.QUARTILES)), ["column"])
    # A mean put together from parts differs in its last digits: four places tell it.
    told = M.state_summary(state).join(quartiles, "column").select("column", "n", *[six(c) for c in NUMBERS[1:]])
    return told.withColumns({c: F.round(c, 4) for c in ("mean", "std")})


@query("describe_grouped", _describe_sql("orders", "o_totalprice", "o_orderstatus"))
def describe_grouped(spark, sf):
    out = E.describe_grouped(read(spark, sf, "orders"), "o_orderstatus", "o_totalprice")
    return out.select("o_orderstatus", "column", "n", *[six(c) for c in NUMBERS[1:]])


@query(
    "null_count",
    f"""WITH {PEOPLE_SQL} UNPIVOT (SELECT count(*) FILTER (balance IS NULL) AS balance, count(*) FILTER (code IS NULL) AS code,
count(*) FILTER (full_name IS NULL) AS full_name FROM people) ON COLUMNS(*) INTO NAME "column" VALUE n_missing""",
)
def null_count(spark, sf):
    return E.null_count(people(spark, sf), ["balance", "code", "full_name"])


@query("row_count", "SELECT count(*) AS n FROM lineitem")
def row_count(spark, sf):
    return E.row_count(read(spark, sf, "lineitem"))


@query(
    "mean_pop_std",
    "SELECT p_brand, round(avg(p_retailprice), 6) AS mean, round(stddev_pop(p_retailprice), 6) AS std FROM part GROUP BY 1",
)
def mean_pop_std(spark, sf):
    return E.mean_pop_std(read(spark, sf, "part"), "p_retailprice", ["p_brand"]).select("p_brand", six("mean"), six("std"))


@query(
    "histogram_hue",
    """WITH e AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders)
SELECT o_orderstatus, CAST(least(floor((o_totalprice - lo) * 30 / (hi - lo)), 29) AS INTEGER) AS bin, count(*) AS n
FROM orders, e GROUP BY 1, 2""",
)
def histogram_hue(spark, sf):
    return E.histogram_hue(read(spark, sf, "orders"), "o_totalprice", "o_orderstatus", 30)


@query(
    "density_grid",
    """WITH s AS (SELECT o_orderstatus, count(*) AS n, stddev_samp(o_totalprice) * pow(count(*), -0.2) AS h,
  min(o_totalprice) AS lo, (max(o_totalprice) - min(o_totalprice)) / 19 AS step FROM orders GROUP BY 1)
SELECT o_orderstatus, CAST(g AS INTEGER) AS point, round(any_value(lo + g * step), 6) AS x,
  round(1000000 * sum(exp(-0.5 * pow((lo + g * step - o_totalprice) / h, 2))) / any_value(n * h * sqrt(2 * pi())), 6) AS density
FROM orders JOIN s USING (o_orderstatus), range(20) t(g) GROUP BY 1, 2""",
)
def density_grid(spark, sf):
    out = E.density_grid(read(spark, sf, "orders"), "o_totalprice", "o_orderstatus", 20)
    return out.select("o_orderstatus", "point", six("x"), F.round(F.col("density") * 1000000, 6).alias("density"))


@query(
    "box_stats",
    """WITH q AS (SELECT l_returnflag, quantile_cont(l_extendedprice, 0.25) AS a, quantile_cont(l_extendedprice, 0.5) AS m,
  quantile_cont(l_extendedprice, 0.75) AS b FROM lineitem GROUP BY 1),
j AS (SELECT l_returnflag, l_extendedprice AS x, a, m, b, l_extendedprice BETWEEN a - 1.5 * (b - a) AND b + 1.5 * (b - a) AS ok
  FROM lineitem JOIN q USING (l_returnflag))
SELECT l_returnflag, round(a, 6) AS q25, round(m, 6) AS q50, round(b, 6) AS q75, round(min(x) FILTER (ok), 6) AS whisker_low,
  round(max(x) FILTER (ok), 6) AS whisker_high, count(*) FILTER (NOT ok) AS n_outliers FROM j GROUP BY l_returnflag, a, m, b""",
)
def box_stats(spark, sf):
    out = E.box_stats(read(spark, sf, "lineitem"), "l_returnflag", "l_extendedprice")
    return out.select("l_returnflag", *[six(c) for c in ("q25", "q50", "q75", "whisker_low", "whisker_high")], "n_outliers")


_PAIR = "least(floor(({c} - (SELECT min({c}) FROM lineitem)) * 10 / (SELECT max({c}) - min({c}) FROM lineitem)), 9)"
_PAIRS = ("l_quantity", "l_extendedprice", "l_discount")


@query(
    "pair_matrix",
    " UNION ALL ".join(
        f"SELECT '{a}' AS x, '{b}' AS y, CAST({_PAIR.format(c=a)} AS INTEGER) AS x_bin, "
        f"CAST({_PAIR.format(c=b)} AS INTEGER) AS y_bin, count(*) AS n FROM lineitem GROUP BY 3, 4"
        for i, a in enumerate(_PAIRS)
        for b in _PAIRS[i:]
    ),
)
def pair_matrix(spark, sf):
    return E.pair_matrix(read(spark, sf, "lineitem"), list(_PAIRS), 10)


# --- order over whole tables ---


@query(
    "rank_pct_average",
    f"""WITH {LONG_SQL} SELECT row_id, model, round((rank() OVER (PARTITION BY model ORDER BY score)
  + (count(*) OVER (PARTITION BY model, score) - 1) / 2) / count(*) OVER (PARTITION BY model), 6) AS rank_pct FROM raw_scores""",
)
def rank_pct_average(spark, sf):
    return W.rank_pct_average(raw_scores(spark, sf), "score", ["model"]).select("row_id", "model", six("rank_pct"))


@query(
    "fill_group_median",
    f"""WITH {TITLED_SQL} SELECT c_custkey, title, round(coalesce(balance, median(balance) OVER (PARTITION BY title)), 6) AS balance
FROM titled""",
)
def fill_group_median(spark, sf):
    table = titled(spark, sf).select("c_custkey", "title", "balance")
    return Q.fill_group_median(table, "title", "balance").select("c_custkey", "title", six("balance"))


@query("rank_min", "SELECT event_id, value, rank() OVER (ORDER BY value DESC) AS rank FROM events")
def rank_min(spark, sf):
    return W.rank_min(read(spark, sf, "events").select("event_id", "value"), "value")


@query("sequence_number", "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS id FROM orders")
def sequence_number(spark, sf):
    return W.sequence_number(read(spark, sf, "orders").select("o_orderkey"), "o_orderkey", "id", 0)
