"""Oracle SQL by query key."""

from __future__ import annotations

from itertools import combinations

from checks import oracle as o
from checks import values as fixed
from checks.queries import LINE_COLUMNS, REPORTS
from checks.tables import messy_numbers_sql

ORACLES: dict[str, str] = {}

DIRTY_KEYS = ("customer_name", "state", "gender")
NA_CASE = (
    "CASE o_orderkey % 7 WHEN 0 THEN 'NA' WHEN 1 THEN 'n/a' WHEN 2 THEN '' WHEN 3 THEN 'NaN' "
    "WHEN 4 THEN 'None ' ELSE o_orderpriority END"
)
TOKENS = ", ".join(o.lit(t) for t in fixed.NA_TOKENS)


def dirty(body: str) -> str:
    return o.customers("dirty", body)


# --- scan, names, text -----------------------------------------------------------
ORACLES["scan_csv"] = """SELECT CAST(p_partkey AS VARCHAR) AS key,
  CASE p_partkey % 4 WHEN 0 THEN p_name || chr(10) || '"' || p_brand || '", x' WHEN 1 THEN ' ' || p_name || ', '
                     WHEN 3 THEN p_name END AS name FROM part"""
ORACLES["scan_processed"] = """
SELECT CAST(k AS VARCHAR) AS customer_id, c_name AS customer_name,
       CASE WHEN k % 5 > 1 THEN CAST(k % 60 + 18 AS DOUBLE) END AS age,
       CASE WHEN k % 4 <> 0 THEN DATE '2024-01-10' END AS signup_date,
       CASE WHEN k % 7 <> 0 THEN CAST(2500.5 AS DOUBLE) END AS income,
       CASE WHEN k % 6 <> 0 THEN CAST(12 AS BIGINT) END AS purchase_count,
       CASE WHEN k % 5 = 0 THEN 'abc' END AS bad_age, CASE WHEN k % 4 = 0 THEN '2024/01/10' END AS bad_signup_date,
       CASE WHEN k % 7 = 0 THEN '1.5.2' END AS bad_income, CASE WHEN k % 6 = 0 THEN 'many' END AS bad_purchase_count
FROM (SELECT c_custkey AS k, c_name FROM customer)"""
ORACLES["scan_na_tokens"] = f"""
SELECT o_orderkey, CASE WHEN p NOT IN ({TOKENS}) THEN p END AS priority,
       CASE WHEN o_orderstatus NOT IN ({TOKENS}) THEN o_orderstatus END AS o_orderstatus
FROM (SELECT o_orderkey, {NA_CASE} AS p, o_orderstatus FROM orders)"""
ORACLES["std_column_names"] = dirty(
    'SELECT * RENAME (income AS income_r) FROM dirty'
)
ORACLES["clean_text"] = f"SELECT doc_id, {o.squeeze('text')} AS text FROM documents"
ORACLES["title_case_name"] = dirty(
    f"SELECT customer_id, {o.title(o.squeeze('customer_name'))} AS customer_name, city FROM dirty"
)
ORACLES["strip_accents"] = "SELECT doc_id, strip_accents(text) AS text FROM documents"
ORACLES["norm_key"] = dirty(
    "SELECT customer_id, " + ", ".join(f"{o.key(c)} AS {c}_key" for c in DIRTY_KEYS) + " FROM dirty"
)
ORACLES["clean_email"] = dirty(
    f"SELECT *, {o.valid_email('email')} AS email_valido FROM (SELECT customer_id, {o.email('email')} AS email FROM dirty)"
)
ORACLES["std_gender"] = dirty(f"SELECT customer_id, {o.gender('gender')} AS gender FROM dirty")
ORACLES["std_state"] = dirty(f"SELECT customer_id, {o.state('state')} AS state FROM dirty")


def unmapped(c: str, known) -> str:
    return (
        f"SELECT value, count(*) AS row_count, '{c}' AS \"column\" FROM (SELECT {o.key(c)} AS value FROM dirty) "
        f"WHERE value NOT IN ({', '.join(o.lit(k) for k in known)}) GROUP BY value"
    )


ORACLES["unmapped_categories"] = dirty(
    o.union([unmapped("gender", fixed.GENDER_CATEGORIES), unmapped("state", o.STATES)])
)

# --- numbers and dates -------------------------------------------------------------
MESSY = f"WITH messy AS ({messy_numbers_sql()})\n"
ORACLES["parse_money"] = MESSY + f"SELECT l_orderkey, l_linenumber, amount, {o.money('amount')} AS value FROM messy"
ORACLES["to_numeric"] = MESSY + f"SELECT l_orderkey, l_linenumber, amount, {o.number('amount')} AS value FROM messy"
ORACLES["convert_numeric"] = o.customers("typed", f"SELECT customer_id, {', '.join(o.NUMBERS)} FROM typed")
ORACLES["parse_dates"] = dirty(
    f"SELECT customer_id, signup_date, {o.day('signup_date')} AS parsed FROM dirty"
)
ORACLES["parse_timestamps"] = """SELECT o_orderkey,
  CASE WHEN o_orderkey % 6 < 3 THEN CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP)
       WHEN o_orderkey % 6 = 3 THEN CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) + INTERVAL '8 hours 30 minutes 5 seconds'
       WHEN o_orderkey % 6 = 4 THEN CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) + INTERVAL '23 hours 59 minutes' END AS at,
  CASE WHEN o_orderkey % 6 < 5 THEN CAST(o_orderdate AS DATE) END AS day FROM orders"""
ORACLES["date_parts"] = dirty(f"""
SELECT customer_id, d AS signup_date, year(d) AS signup_date_year, month(d) AS signup_date_month,
       quarter(d) AS signup_date_quarter, dayname(d) AS signup_date_weekday
FROM (SELECT customer_id, {o.day('signup_date')} AS d FROM dirty)""")
ORACLES["validate_range"] = o.customers(
    "typed", "SELECT customer_id, CASE WHEN age BETWEEN 18 AND 100 THEN age END AS age FROM typed"
)
ORACLES["range_report"] = o.customers("typed", f"""
SELECT 'age' AS coluna, '18 <= age <= 100' AS regra, count(*) FILTER (age NOT BETWEEN 18 AND 100) AS quantidade_invalida,
       {o.pct('count(*) FILTER (age NOT BETWEEN 18 AND 100)', 'count(*)')} AS percentual_invalido,
       {o.lit(fixed.RANGE_STRATEGY)} AS estrategia FROM typed""")
ORACLES["invalid_range_values"] = dirty(
    f"SELECT age AS value, count(*) AS row_count FROM dirty WHERE {o.number('age')} NOT BETWEEN 18 AND 100 GROUP BY age"
)

# --- imputation ------------------------------------------------------------------
ORACLES["impute_global_median"] = o.customers("done", "SELECT customer_id, age, satisfaction_score FROM filled")
ORACLES["impute_income_by_group"] = o.customers("done", "SELECT customer_id, state, income FROM filled")
ORACLES["impute_without_group"] = o.customers(
    "uniq", "SELECT customer_id, coalesce(income, (SELECT median(income) FROM uniq)) AS income FROM uniq"
)
ORACLES["impute_constant"] = o.customers("done", "SELECT customer_id, city FROM filled")
ORACLES["handle_missing"] = o.customers(
    "done", "SELECT customer_id, age, income, satisfaction_score, city FROM filled"
)
_MISSING = fixed.MISSING_TEXTS


def _strategy(c: str, text: str) -> str:
    share = o.pct(f"count(*) FILTER ({c} IS NULL)", "count(*)")
    return f"SELECT '{c}' AS coluna, {share} AS missing_percent, {text} AS estrategia FROM uniq"


ORACLES["missing_strategy"] = o.customers("uniq", o.union([
    _strategy("age", f"printf({o.lit(_MISSING['global'])}, median(age))"),
    _strategy("income", o.lit(_MISSING["group"].format(group="state"))),
    _strategy("satisfaction_score", f"printf({o.lit(_MISSING['global'])}, median(satisfaction_score))"),
    _strategy("city", o.lit(_MISSING["constant"])),
]))

# --- quality ---------------------------------------------------------------------
ORACLES["completeness"] = o.customers("cleaned", o.union(o.completeness("cleaned", o.CLEAN_COLUMNS)))
ORACLES["uniqueness"] = o.customers("cleaned", o.union(o.uniqueness("cleaned")))
ORACLES["validity_checks"] = o.customers("cleaned", o.union(o.validity("cleaned", True)))
ORACLES["consistency_checks"] = o.customers("cleaned", o.union(o.consistency("cleaned")))
_RAW_REPORT = o.report("typed", o.CUSTOMER, False)
ORACLES["dq_report"] = o.customers("typed", _RAW_REPORT)
ORACLES["dq_score"] = o.customers("typed", f"SELECT round(coalesce(avg(value), 0.0), 2) AS score FROM ({_RAW_REPORT})")
ORACLES["worst_metrics"] = o.customers(
    "typed", f"SELECT metric, value, status FROM ({_RAW_REPORT}) ORDER BY value ASC NULLS LAST, metric LIMIT 10"
)
_DONE_REPORT = o.report("done", (*o.CLEAN_COLUMNS, "customer_segment"), True)
ORACLES["dq_before_after"] = "WITH " + ",\n".join([o.DIRTY, o.TYPED, o.CLEANED, o.UNIQUE, o.DONE]) + f"""
SELECT metric, b.value AS "before", a.value AS "after", round(a.value - b.value, 2) AS delta,
       b.status AS status_before, a.status AS status_after
FROM ({_RAW_REPORT}) b FULL JOIN ({_DONE_REPORT}) a USING (metric)"""

# --- profiling ---------------------------------------------------------------------
ORACLES["table_profile"] = dirty(o.union(
    f"SELECT CAST({i + 1} AS BIGINT) AS position, '{c}' AS \"column\", 'string' AS data_type, count(*) AS row_count, "
    f"CAST({len(o.CUSTOMER)} AS BIGINT) AS column_count, count({c}) AS non_null_count FROM dirty"
    for i, c in enumerate(o.CUSTOMER)
))
ORACLES["missing_summary"] = dirty("SELECT * FROM (" + o.union(
    f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS missing_count, {o.pct(f'(count(*) - count({c}))', 'count(*)')} AS missing_percentage FROM dirty"
    for c in o.CUSTOMER
) + ") WHERE missing_count > 0")
ORDER_COLUMNS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
ORACLES["cardinality"] = o.union(
    f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS distinct_count FROM orders" for c in ORDER_COLUMNS
)
ORACLES["value_counts"] = "SELECT event_type AS value, count(*) AS row_count FROM events GROUP BY event_type"
ORACLES["value_share_top5"] = o.customers("uniq", """
SELECT state AS value, count(*) AS row_count, round(100.0 * count(*) / (SELECT count(state) FROM uniq), 1) AS percentage
FROM uniq WHERE state IS NOT NULL GROUP BY state ORDER BY row_count DESC, value LIMIT 5""")
ORACLES["yearly_counts"] = "SELECT year(o_orderdate) AS value, count(*) AS row_count FROM orders GROUP BY 1"


def top_text(c: str) -> str:
    return (
        f"SELECT '{c}' AS \"column\", sum(n)::BIGINT AS \"count\", count(*) AS \"unique\", "
        f"arg_min(v, (-n, v)) AS top, max(n) AS freq FROM (SELECT CAST({c} AS VARCHAR) AS v, count(*) AS n FROM lineitem GROUP BY 1)"
    )


ALL_LINE_COLUMNS = (
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus", "l_shipdate",
)
ORACLES["describe_text"] = o.union(top_text(c) for c in ALL_LINE_COLUMNS)
ORACLES["distinct_values"] = dirty("SELECT DISTINCT state AS value FROM dirty WHERE state IS NOT NULL")

# --- duplicates --------------------------------------------------------------------
_ALL = ", ".join(o.CUSTOMER)
ORACLES["full_duplicates"] = dirty(f"SELECT * FROM dirty QUALIFY count(*) OVER (PARTITION BY {_ALL}) > 1")
ORACLES["drop_full_duplicates"] = dirty("SELECT DISTINCT * FROM dirty")
ORACLES["key_duplicates"] = dirty(
    "SELECT * FROM (SELECT DISTINCT * FROM dirty) QUALIFY count(*) OVER (PARTITION BY customer_id) > 1"
)
ORACLES["dedup_by_key"] = """
SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS FIRST,
  o_orderkey DESC, o_orderstatus DESC, o_totalprice DESC, o_orderpriority DESC) = 1"""
ORACLES["dedup_keep_first"] = """
SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts ASC NULLS LAST,
  event_id, event_type, value, props) = 1"""
ORACLES["dedup_keep_none"] = dirty("SELECT * FROM dirty QUALIFY count(*) OVER (PARTITION BY customer_id) = 1")
ORACLES["duplicate_counts"] = dirty(f"""
SELECT count(*) AS total_rows, count(*) - count(DISTINCT ({_ALL})) AS full_duplicate_rows,
       count(*) FILTER (k > 1) AS rows_in_repeated_keys, count(DISTINCT customer_id) AS distinct_keys,
       count(DISTINCT ({_ALL})) AS distinct_rows, count(DISTINCT customer_id) AS key_groups,
       count(*) - count(DISTINCT customer_id) AS rows_minus_keys
FROM (SELECT *, count(*) OVER (PARTITION BY customer_id) AS k FROM dirty)""")
ORACLES["fuzzy_duplicates"] = o.fuzzy("uniq", "customer_id", "customer_name", 90.0, o.UNIQUE_PREFIX)
_REPEATED = f"{o.DIRTY},\n{o.CLEANED},\n"
ORACLES["fuzzy_repeated_ids"] = o.fuzzy("cleaned", "customer_id", "customer_name", 90.0, _REPEATED)
ORACLES["fuzzy_record_pairs"] = o.fuzzy_records(
    "cleaned", "customer_id", "customer_name", 90.0, "f.block = 'p' AND tokens_1 LIKE '1%'", _REPEATED
)
ORACLES["fuzzy_part_names"] = o.fuzzy("part", "p_partkey", "p_name", 70.0)
_SUMMARY = o.fuzzy("uniq", "customer_id", "customer_name", 90.0, o.UNIQUE_PREFIX)
_STEPS = [
    "(SELECT count(*) FROM cleaned)",
    "(SELECT count(*) FROM cleaned) - (SELECT count(*) FROM (SELECT DISTINCT * FROM cleaned))",
    "(SELECT count(*) FROM (SELECT DISTINCT * FROM cleaned)) - (SELECT count(*) FROM uniq)",
    "(SELECT count(*) FROM uniq)",
    "(SELECT sum(record_pairs)::BIGINT FROM found)",
]
ORACLES["dedup_summary"] = _SUMMARY[: _SUMMARY.rindex("SELECT r1.i AS record_1")] + o.union(
    f"SELECT {o.lit(step)} AS etapa, {value} AS quantidade" for step, value in zip(fixed.DEDUP_STEPS, _STEPS)
)
ORACLES["token_sort_similarity"] = f"""WITH RECURSIVE sides AS (
  SELECT p_partkey, {o.sorted_tokens('p_name')} AS x, {o.sorted_tokens("lower(p_type || ' ' || p_name)")} AS y FROM part),
pairs AS (SELECT DISTINCT x, y FROM sides),
{o.LCS}
SELECT p_partkey, round(score, 6) AS similarity FROM sides JOIN scored USING (x, y)"""

# --- describe, outliers, segments ------------------------------------------------------
ORACLES["describe_numeric"] = o.describe("lineitem", LINE_COLUMNS, 4, variance=2, mean=2, std=2)
ORACLES["describe_customers"] = o.customers("done", o.describe("done", o.NUMBERS, 4, variance=0, mean=2, std=2))
ORACLES["describe_basic"] = f"""
SELECT "column", "count", round(mean, 4) AS mean, round(std, 4) AS std, round("min", 4) AS "min", round(p25, 4) AS p25,
       round(p50, 4) AS p50, round(p75, 4) AS p75, round("max", 4) AS "max" FROM ({o.statistics('events', 'value')})"""
ORACLES["distribution_shape"] = f"""
SELECT "column", {o.shapes()} FROM ({o.union(o.statistics('events', c) for c in ('event_id', 'user_id', 'value'))})"""
PROBS = (0.01, 1 / 3, 0.5, 2 / 3, 0.999)
ORACLES["quantiles"] = o.union(
    f"SELECT '{c}' AS \"column\", round(CAST({p!r} AS DOUBLE), 6) AS prob, round(quantile_cont(CAST({c} AS DOUBLE), {p!r}), 6) AS value FROM lineitem"
    for c in LINE_COLUMNS
    for p in PROBS
)
ORACLES["outliers_iqr"] = o.union(o.outliers("events", c) for c in ("user_id", "value"))
ORACLES["outlier_actions"] = o.customers("done", f"""
SELECT "column", outlier_percentage, {o.actions('outlier_percentage')} AS action
FROM ({o.union(o.outliers('done', c) for c in o.NUMBERS)})""")
SEGMENTED = f"WITH {o.SPENDING}\n"
ORACLES["customer_segments"] = SEGMENTED + "SELECT customer_id, total_spent, customer_segment FROM segmented"
ORACLES["segment_summary"] = SEGMENTED + "SELECT customer_segment, " + ", ".join(
    f"round(avg({c}), 2) AS {c}_mean, round(CAST(median({c}) AS DOUBLE), 2) AS {c}_median, count({c}) AS {c}_count"
    for c in ("income", "purchase_count", "total_spent")
) + " FROM segmented GROUP BY customer_segment"
ORACLES["median_split_groups"] = o.customers("uniq", f"""
SELECT customer_id, satisfaction_score, CASE WHEN satisfaction_score >= (SELECT median(satisfaction_score) FROM uniq)
       THEN {o.lit(fixed.MEDIAN_SPLIT_LABELS[0])} ELSE {o.lit(fixed.MEDIAN_SPLIT_LABELS[1])} END AS grupo
FROM uniq WHERE satisfaction_score IS NOT NULL""")
ORACLES["segment_axis_cap"] = SEGMENTED + """
SELECT round(max(w), 4) AS upper_whisker, round(max(w) * 1.15, 4) AS axis_cap FROM (
  SELECT quantile_cont(total_spent, 0.75) + 1.5 * (quantile_cont(total_spent, 0.75) - quantile_cont(total_spent, 0.25)) AS w
  FROM segmented GROUP BY customer_segment)"""

# --- ranks, correlation, tests ---------------------------------------------------------
ORACLES["avg_rank"] = o.union(
    f"""SELECT '{c}' AS "column", CAST({c} AS DOUBLE) AS value, count(*) AS n,
        sum(count(*)) OVER (ORDER BY {c}) - count(*) + (count(*) + 1) / 2.0 AS avg_rank FROM lineitem GROUP BY {c}"""
    for c in LINE_COLUMNS
)
ORACLES["avg_rank_rows"] = """
SELECT l_orderkey, l_linenumber, l_extendedprice,
       rank() OVER (ORDER BY l_extendedprice) + (count(*) OVER (PARTITION BY l_extendedprice) - 1) / 2.0 AS avg_rank
FROM lineitem"""
ORACLES["corr_pearson"] = o.matrix("lineitem", LINE_COLUMNS, "pearson")
ORACLES["corr_spearman"] = o.matrix("lineitem", LINE_COLUMNS, "spearman")
ORACLES["corr_spearman_missing"] = o.customers("uniq", o.matrix("uniq", o.NUMBERS, "spearman"))
ORACLES["top_corr_pairs"] = "SELECT variable_1, variable_2, 'spearman' AS method, round(r, 6) AS correlation FROM (" + o.union(
    f"SELECT '{a}' AS variable_1, '{b}' AS variable_2, r FROM ({o.correlation('lineitem', a, b, 'spearman')})"
    for a, b in combinations(LINE_COLUMNS, 2)
) + ") ORDER BY abs(r) DESC, variable_1, variable_2 LIMIT 4"
ORACLES["test_pearson"] = o.corr_test("lineitem", "l_quantity", "l_extendedprice", "pearson")
ORACLES["test_spearman"] = o.corr_test("lineitem", "l_discount", "l_tax", "spearman")
ORACLES["test_welch_t"] = o.welch("orders", "o_totalprice", "o_orderstatus", "F", "O")
ORACLES["test_mann_whitney"] = o.mann_whitney("events", "value", "event_type", "click", "error")
#: Ways to choose three of N ranks with a sum of at most S, counted pair by pair.
ORACLES["test_mann_whitney_small"] = """WITH v AS (
  SELECT CAST(CAST(round(o_totalprice * 100) AS BIGINT) * 1000000 + o_orderkey AS DOUBLE) AS value,
         o_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderkey % 5000 = 1 ORDER BY 1 LIMIT 3) AS few FROM orders),
r AS (SELECT value, few, row_number() OVER (ORDER BY value) AS k FROM v),
u AS (SELECT count(*) FILTER (few) AS a, count(*) FILTER (NOT few) AS b, sum(k) FILTER (few) - 6 AS u, count(*) AS n,
             median(value) FILTER (few) AS ma, median(value) FILTER (NOT few) AS mb FROM r),
s AS (SELECT *, a * b - greatest(u, a * b - u) + 6 AS most FROM u),
w AS (SELECT sum(greatest(0, least(n, most - i.i - j.i) - j.i)) AS ways
      FROM s, range(1, (SELECT n + 1 FROM u)) i(i) JOIN range(1, (SELECT n + 1 FROM u)) j(i) ON j.i > i.i
      WHERE i.i + 2 * j.i < most)
SELECT a AS n_a, b AS n_b, ma AS median_a, mb AS median_b, CAST(u AS DOUBLE) AS statistic,
       round(least(1.0, 12.0 * ways / (CAST(n AS DOUBLE) * (n - 1) * (n - 2))), 12) AS p_value FROM s, w"""
ORACLES["test_anova"] = o.anova("orders", "o_totalprice", "o_orderpriority")
ORACLES["test_battery"] = o.customers("done", o.union([
    o.corr_test("done", "income", "total_spent", "pearson"),
    o.corr_test("done", "purchase_count", "total_spent", "pearson"),
    *[o.corr_test("done", c, "total_spent", "spearman") for c in ("income", "purchase_count", "satisfaction_score", "age")],
    o.mann_whitney("done", "satisfaction_score", "customer_segment", *fixed.SEGMENT_TEST_PAIR),
    o.anova("done", "income", "customer_segment"),
    o.welch("done", "total_spent", "gender", *fixed.GENDER_TEST_PAIR),
]))

# --- chart data ------------------------------------------------------------------------
ORACLES["histogram"] = """WITH e AS (
  SELECT min(value) AS lo, max(value) AS hi, avg(value) AS mean, median(value) AS med FROM events),
c AS (SELECT least(CAST(floor((value - lo) / ((hi - lo) / 40)) AS BIGINT), 39) AS bin, count(*) AS n FROM events, e GROUP BY 1)
SELECT g.i AS bin, round(lo + g.i * ((hi - lo) / 40), 6) AS bin_start, round(lo + (g.i + 1) * ((hi - lo) / 40), 6) AS bin_end,
       coalesce(n, 0) AS row_count, round(mean, 6) AS mean, round(med, 6) AS median
FROM range(40) g(i) CROSS JOIN e LEFT JOIN c ON c.bin = g.i"""
ORACLES["kde_grid"] = """WITH e AS (
  SELECT min(value) AS lo, max(value) AS hi, count(*) AS n, stddev_samp(value) * pow(count(*), -0.2) AS h FROM events),
c AS (SELECT value, count(*) AS w FROM events GROUP BY value),
d AS (
  SELECT g.i AS point, any_value(lo + g.i * (hi - lo) / 199) AS x, any_value((hi - lo) / 40) AS bw, any_value(n) AS n,
         sum(w * exp(-pow((lo + g.i * ((hi - lo) / 199) - value) / h, 2) / 2)) / any_value(n * h * sqrt(2 * pi())) AS density
  FROM range(200) g(i), e, c GROUP BY g.i)
SELECT point, round(x, 8) AS x, round(density, 8) AS density, round(density * n * bw, 5) AS scaled FROM d"""
ORACLES["boxplot_stats"] = """WITH q AS (
  SELECT event_type, count(*) AS n, quantile_cont(value, 0.25) AS q1, median(value) AS med, quantile_cont(value, 0.75) AS q3
  FROM events GROUP BY event_type),
v AS (SELECT e.event_type, value, n, q1, med, q3, value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside
  FROM events e JOIN q ON q.event_type = e.event_type)
SELECT event_type, 'value' AS "column", n, round(q1, 6) AS q1, round(med, 6) AS median, round(q3, 6) AS q3,
       round(min(value) FILTER (inside), 6) AS whisker_low, round(max(value) FILTER (inside), 6) AS whisker_high,
       count(*) FILTER (NOT inside) AS flier_count FROM v GROUP BY event_type, n, q1, med, q3"""
ORACLES["boxplot_overall"] = o.union(f"""SELECT * FROM (WITH q AS (
  SELECT count({c}) AS n, quantile_cont({c}, 0.25) AS q1, median({c}) AS med, quantile_cont({c}, 0.75) AS q3 FROM lineitem),
v AS (SELECT {c} AS value, n, q1, med, q3, {c} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside FROM lineitem, q)
SELECT '{c}' AS "column", n, round(q1, 6) AS q1, round(med, 6) AS median, round(q3, 6) AS q3,
       round(min(value) FILTER (inside), 6) AS whisker_low, round(max(value) FILTER (inside), 6) AS whisker_high,
       count(*) FILTER (NOT inside) AS flier_count FROM v GROUP BY n, q1, med, q3)""" for c in ("l_quantity", "l_extendedprice"))
ORACLES["state_counts_topn"] = o.customers("uniq", """
SELECT state AS value, count(*) AS row_count FROM uniq WHERE state IS NOT NULL GROUP BY state ORDER BY 2 DESC, 1 LIMIT 4""")
ORACLES["monthly_counts"] = "SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, count(*) AS row_count FROM orders GROUP BY 1"
ORACLES["scatter_bins"] = SEGMENTED.rstrip() + """,
m AS (SELECT greatest(median(total_spent), 1) AS t FROM spending),
p AS (SELECT CAST(purchase_count AS DOUBLE) AS x, c_mktsegment AS hue,
  CASE WHEN abs(total_spent) <= t THEN total_spent * (1 / (1 - 0.1))
       ELSE sign(total_spent) * t * ((1 / (1 - 0.1)) + log10(abs(total_spent) / t)) END AS y FROM spending, m),
e AS (SELECT min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1 FROM p)
SELECT least(CAST(floor((x - x0) / ((x1 - x0) / 50)) AS BIGINT), 49) AS x_bin,
       least(CAST(floor((y - y0) / ((y1 - y0) / 50)) AS BIGINT), 49) AS y_bin, hue, count(*) AS row_count
FROM p, e GROUP BY 1, 2, 3"""

# --- the batch job -----------------------------------------------------------------------------
_WRITTEN = {
    "deduplication_summary": ORACLES["dedup_summary"],
    "age_validation_report": ORACLES["range_report"],
    "missing_values_strategy": ORACLES["missing_strategy"],
    "data_quality_report_raw": ORACLES["dq_report"],
    "data_quality_report": o.customers("done", _DONE_REPORT),
}
ORACLES["batch_reports"] = o.union(
    f"SELECT '{name}' AS report, {columns[0]} AS \"row\", '{c}' AS field, CAST({c} AS VARCHAR) AS value FROM ({_WRITTEN[name]})"
    for name, columns in REPORTS.items()
    for c in columns[1:]
)
