"""Independent SQL (DuckDB) for the registered queries."""

from __future__ import annotations

from checks import values as fixed
from checks.tables import dirty_customers_sql

CUSTOMER = (
    "customer_id", "customer_name", "email", "age", "gender", "city", "state", "signup_date",
    "income", "purchase_count", "total_spent", "satisfaction_score",
)
NUMBERS = ("age", "income", "purchase_count", "total_spent", "satisfaction_score")
STRICT = r"^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?$"


def lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def union(parts) -> str:
    return "\nUNION ALL\n".join(parts)


# --- scalar expressions ------------------------------------------------------------


def squeeze(c: str) -> str:
    return rf"trim(regexp_replace({c}, '\s+', ' ', 'g'))"


def key(c: str) -> str:
    return f"lower(trim(strip_accents({c})))"


def title(c: str) -> str:
    runs = rf"regexp_extract_all({c}, '(\p{{L}}+|[^\p{{L}}]+)')"
    return f"CASE WHEN {c} IS NOT NULL THEN array_to_string(list_transform({runs}, lambda x: upper(x[1]) || lower(x[2:])), '') END"


def number(c: str) -> str:
    return f"CASE WHEN regexp_full_match(trim({c}), '{STRICT}') THEN TRY_CAST(trim({c}) AS DOUBLE) END"


def money(c: str) -> str:
    bare = f"replace(trim(replace(trim({c}), 'R$', '')), ' ', '')"
    body = (
        f"CASE WHEN contains({bare}, ',') THEN replace(replace({bare}, '.', ''), ',', '.') "
        rf"WHEN regexp_matches({bare}, '\.[^.]{{3}}$') THEN replace({bare}, '.', '') ELSE {bare} END"
    )
    return f"CASE WHEN regexp_full_match({body}, '{STRICT}') THEN TRY_CAST(({body}) AS DOUBLE) END"


def day(c: str) -> str:
    return f"CAST(try_strptime(trim({c}), ['%Y-%m-%d', '%d/%m/%Y', '%d-%m-%Y', '%Y/%m/%d']) AS DATE)"


def category(c: str, mapping: dict[str, str], default: str) -> str:
    whens = " ".join(f"WHEN {lit(k)} THEN {lit(v)}" for k, v in mapping.items())
    return f"CASE WHEN {c} IS NULL THEN NULL ELSE CASE {key(c)} {whens} ELSE {lit(default)} END END"


def gender(c: str) -> str:
    return category(c, fixed.GENDER_CATEGORIES, fixed.GENDER_DEFAULT)


STATES = {code.lower(): code for code in fixed.STATE_NAMES} | {n: c for c, n in fixed.STATE_NAMES.items()}


def state(c: str) -> str:
    return category(c, STATES, fixed.STATE_DEFAULT)


def email(c: str) -> str:
    return rf"lower(regexp_replace({c}, '\s+', '', 'g'))"


def valid_email(c: str) -> str:
    return rf"coalesce(regexp_matches({c}, '^[^@\s]+@[^@\s]+\.[^@\s]+$'), false)"


def pct(part: str, whole: str) -> str:
    return f"coalesce(round(100.0 * {part} / nullif({whole}, 0), 2), 0.0)"


def whole_count(c: str) -> str:
    return f"CAST(round_even({number(c)}, 0) AS BIGINT)"


# --- the customer table, step by step --------------------------------------------------

TYPED = f"""typed AS (
  SELECT customer_id, customer_name, email, {number('age')} AS age, gender, city, state, signup_date,
         {money('income')} AS income, {whole_count('purchase_count')} AS purchase_count,
         {money('total_spent')} AS total_spent, {number('satisfaction_score')} AS satisfaction_score
  FROM dirty)"""

CLEANED = f"""parsed AS (
  SELECT customer_id, {title(squeeze('customer_name'))} AS customer_name, {email('email')} AS email,
         CASE WHEN {number('age')} BETWEEN 18 AND 100 THEN {number('age')} END AS age,
         {gender(squeeze('gender'))} AS gender, {squeeze('city')} AS city, {state(squeeze('state'))} AS state,
         {day('signup_date')} AS signup_date, {money('income')} AS income,
         {whole_count('purchase_count')} AS purchase_count, {money('total_spent')} AS total_spent,
         {number('satisfaction_score')} AS satisfaction_score
  FROM dirty),
cleaned AS (
  SELECT *, {valid_email('email')} AS email_valido, year(signup_date) AS signup_date_year,
         month(signup_date) AS signup_date_month, quarter(signup_date) AS signup_date_quarter,
         dayname(signup_date) AS signup_date_weekday
  FROM parsed)"""

_TIES = ", ".join(
    f"{c} DESC NULLS LAST"
    for c in (*[c for c in CUSTOMER if c not in ("customer_id", "signup_date")], "email_valido")
)
UNIQUE = f"""uniq AS (
  SELECT * FROM (SELECT DISTINCT * FROM cleaned)
  QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY signup_date DESC NULLS FIRST, {_TIES}) = 1)"""

DONE = """filled AS (
  SELECT u.* EXCLUDE (age, income, satisfaction_score, city),
         coalesce(age, (SELECT median(age) FROM uniq)) AS age,
         coalesce(income, g.m, (SELECT median(income) FROM uniq)) AS income,
         coalesce(satisfaction_score, (SELECT median(satisfaction_score) FROM uniq)) AS satisfaction_score,
         coalesce(city, 'unknown') AS city
  FROM uniq u LEFT JOIN (SELECT state AS s, median(income) AS m FROM uniq WHERE state IS NOT NULL GROUP BY state) g ON u.state = g.s),
done AS (
  SELECT *, CASE WHEN total_spent <= quantile_cont(total_spent, 1/3) OVER () THEN 'Low Value'
                 WHEN total_spent <= quantile_cont(total_spent, 2/3) OVER () THEN 'Medium Value'
                 WHEN total_spent IS NOT NULL THEN 'High Value' END AS customer_segment
  FROM filled)"""

DIRTY = f"dirty AS ({dirty_customers_sql()})"


def customers(step: str, body: str) -> str:
    """``body`` over the customer table after ``step``."""
    chain = {"dirty": [], "typed": [TYPED], "cleaned": [CLEANED], "uniq": [CLEANED, UNIQUE], "done": [CLEANED, UNIQUE, DONE]}
    return "WITH " + ",\n".join([DIRTY, *chain[step]]) + "\n" + body


SPENDING = """spending AS (
  SELECT c_custkey AS customer_id, CAST(coalesce(sum(CAST(floor(o_totalprice) AS BIGINT)), 0) AS DOUBLE) AS total_spent,
         count(o_custkey) AS purchase_count, any_value(c_acctbal) AS income, any_value(c_mktsegment) AS c_mktsegment
  FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey),
segmented AS (
  SELECT *, CASE WHEN total_spent <= quantile_cont(total_spent, 1/3) OVER () THEN 'Low Value'
                 WHEN total_spent <= quantile_cont(total_spent, 2/3) OVER () THEN 'Medium Value'
                 ELSE 'High Value' END AS customer_segment FROM spending)"""

# --- quality reports ---------------------------------------------------------------------


def status(worse: str, ok: float, warn: float) -> str:
    return (
        f"CASE WHEN {worse} <= {ok} THEN {lit(fixed.STATUS_OK)} WHEN {worse} <= {warn} THEN {lit(fixed.STATUS_WARN)} "
        f"ELSE {lit(fixed.STATUS_BAD)} END"
    )


def metric(source: str, name: str, value: str, ok: float, warn: float, text: str, worse: str = "100 - value") -> str:
    return (
        f"SELECT {lit(name)} AS metric, value, {status(worse, ok, warn)} AS status, {text} AS description "
        f"FROM (SELECT {value} AS value, count(*) AS total FROM {source})"
    )


def completeness(source: str, columns) -> list[str]:
    texts = fixed.QUALITY_TEXTS["completeness"]
    return [
        metric(source, f"completeness_{c}", pct(f"count({c})", "count(*)"), 2, 10, lit(texts.format(column=c)))
        for c in columns
    ]


def uniqueness(source: str) -> list[str]:
    text = (
        "printf(" + lit(fixed.QUALITY_TEXTS["uniqueness"]) + ", 'customer_id', u, total, total - u)"
    )
    return [
        f"SELECT 'uniqueness_customer_id' AS metric, value, {status('100 - value', 0, 1)} AS status, {text} AS description "
        f"FROM (SELECT {pct('count(DISTINCT customer_id)', 'count(*)')} AS value, count(DISTINCT customer_id) AS u, count(*) AS total FROM {source})"
    ]


def validity(source: str, with_email: bool) -> list[str]:
    rules = [("validity_age", pct("count(*) FILTER (age BETWEEN 18 AND 100)", "count(*)"))]
    if with_email:
        rules.append(("validity_email", "round(100 * avg(CAST(email_valido AS INT)), 2)"))
    rules += [
        ("validity_satisfaction_score", pct("count(*) FILTER (satisfaction_score BETWEEN 1 AND 5)", "count(*)")),
        ("validity_income_positive", pct("count(*) FILTER (income > 0)", "count(*)")),
    ]
    return [metric(source, n, v, 1, 5, lit(fixed.QUALITY_TEXTS[n])) for n, v in rules]


def consistency(source: str) -> list[str]:
    odd = pct("count(*) FILTER (purchase_count = 0 AND total_spent > 0)", "count(*)")
    name = "consistency_purchase_vs_spent"
    rules = [
        ("consistency_gender_categories", pct("count(*) FILTER (gender IN ('masculino', 'feminino', 'outro'))", "count(*)")),
        ("consistency_state_format", pct("count(*) FILTER (length(state) = 2)", "count(*)")),
    ]
    return [metric(source, n, v, 0, 2, lit(fixed.QUALITY_TEXTS[n])) for n, v in rules] + [
        f"SELECT {lit(name)} AS metric, round(100 - odd, 2) AS value, {status('odd', 0.5, 2)} AS status, "
        f"{lit(fixed.QUALITY_TEXTS[name])} AS description FROM (SELECT {odd} AS odd FROM {source})"
    ]


def report(source: str, columns, with_email: bool) -> str:
    note = f"SELECT 'accuracy_note' AS metric, CAST(NULL AS DOUBLE) AS value, 'N/A' AS status, {lit(fixed.QUALITY_TEXTS['accuracy_note'])} AS description"
    return union(
        [*completeness(source, columns), *uniqueness(source), *validity(source, with_email), *consistency(source), note]
    )


CLEAN_COLUMNS = (
    *CUSTOMER, "email_valido", "signup_date_year", "signup_date_month", "signup_date_quarter", "signup_date_weekday",
)

# --- statistics ---------------------------------------------------------------------------


def statistics(source: str, c: str) -> str:
    """Unrounded descriptive statistics of one column."""
    ps = ", ".join(f"quantile_cont(v, {p / 100}) AS p{p}" for p in fixed.PERCENTILES)
    return f"""SELECT '{c}' AS "column", m.*, s.skewness, s.kurtosis, o.mode FROM
      (SELECT count(v) AS "count", avg(v) AS mean, median(v) AS median, stddev_samp(v) AS std, var_samp(v) AS variance,
              min(v) AS "min", max(v) AS "max", max(v) - min(v) AS "range", quantile_cont(v, 0.25) AS q1,
              quantile_cont(v, 0.75) AS q3, quantile_cont(v, 0.75) - quantile_cont(v, 0.25) AS iqr, {ps},
              stddev_samp(v) / nullif(avg(v), 0) * 100 AS coefficient_of_variation
       FROM (SELECT CAST({c} AS DOUBLE) AS v FROM {source})) m,
      (SELECT avg(pow(v - mu, 3)) / pow(avg(pow(v - mu, 2)), 1.5) AS skewness,
              avg(pow(v - mu, 4)) / pow(avg(pow(v - mu, 2)), 2) - 3 AS kurtosis
       FROM (SELECT CAST({c} AS DOUBLE) AS v, avg(CAST({c} AS DOUBLE)) OVER () AS mu FROM {source} WHERE {c} IS NOT NULL)) s,
      (SELECT CAST({c} AS DOUBLE) AS mode FROM {source} WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1) o"""


def describe(source: str, columns, digits: int, **special: int) -> str:
    names = [
        "mean", "median", "mode", "std", "variance", "min", "max", "range", "q1", "q3", "iqr",
        *[f"p{p}" for p in fixed.PERCENTILES], "skewness", "kurtosis", "coefficient_of_variation",
    ]
    out = ", ".join(f'round("{n}", {special.get(n, digits)}) AS "{n}"' for n in names)
    return f'SELECT "column", "count", {out} FROM ({union(statistics(source, c) for c in columns)})'


def outliers(source: str, c: str) -> str:
    bounds = f"SELECT quantile_cont({c}, 0.25) AS a, quantile_cont({c}, 0.75) AS b FROM {source}"
    return f"""SELECT '{c}' AS "column", round(a, 6) AS q1, round(b, 6) AS q3, round(b - a, 6) AS iqr,
      round(a - 1.5 * (b - a), 6) AS lower_bound, round(b + 1.5 * (b - a), 6) AS upper_bound, count({c}) AS total_records,
      count(*) FILTER ({c} < a - 1.5 * (b - a) OR {c} > b + 1.5 * (b - a)) AS outlier_count,
      {pct(f"count(*) FILTER ({c} < a - 1.5 * (b - a) OR {c} > b + 1.5 * (b - a))", f"count({c})")} AS outlier_percentage
      FROM {source}, ({bounds}) GROUP BY a, b"""


def actions(c: str) -> str:
    t = fixed.OUTLIER_ACTIONS
    return (
        f"CASE WHEN {c} = 0 THEN {lit(t['none'])} WHEN {c} < 1 THEN {lit(t['low'])} "
        f"WHEN {c} < 5 THEN {lit(t['moderate'])} ELSE {lit(t['high'])} END"
    )


def shapes() -> str:
    s, k = fixed.SKEW_LABELS, fixed.KURTOSIS_LABELS
    return (
        f"CASE WHEN skewness > 1 THEN {lit(s['strong_right'])} WHEN skewness > 0.5 THEN {lit(s['mild_right'])} "
        f"WHEN skewness < -1 THEN {lit(s['strong_left'])} WHEN skewness < -0.5 THEN {lit(s['mild_left'])} "
        f"ELSE {lit(s['symmetric'])} END AS assimetria, "
        f"CASE WHEN kurtosis > 1 THEN {lit(k['heavy'])} WHEN kurtosis < -1 THEN {lit(k['light'])} ELSE {lit(k['normal'])} END AS curtose"
    )


# --- correlation and tests -------------------------------------------------------------------


def ranked(source: str, x: str, y: str) -> str:
    """Average ranks of the complete rows of a pair."""

    def rank(c: str) -> str:
        return f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0"

    return f"SELECT {rank(x)} AS rx, {rank(y)} AS ry FROM {source} WHERE {x} IS NOT NULL AND {y} IS NOT NULL"


def correlation(source: str, x: str, y: str, method: str) -> str:
    if method == "pearson":
        return f"SELECT corr({x}, {y}) AS r, count(*) FILTER ({x} IS NOT NULL AND {y} IS NOT NULL) AS n FROM {source}"
    return f"SELECT corr(rx, ry) AS r, count(*) AS n FROM ({ranked(source, x, y)})"


def matrix(source: str, columns, method: str) -> str:
    cells = []
    for a in columns:
        row = [
            "1.0" if a == b else f"(SELECT round(r, 6) FROM ({correlation(source, *sorted((a, b)), method)}))"
            for b in columns
        ]
        cells.append(f"SELECT '{a}' AS \"index\", " + ", ".join(f"{v} AS {c}" for v, c in zip(row, columns)))
    return union(cells)


STEPS = 4000


def simpson(density: str, upper: str, steps: int = STEPS) -> str:
    """Integral of ``density`` (in x) from 0 to ``upper``."""
    weight = f"CASE WHEN i = 0 OR i = {steps} THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END"
    at = density.replace("{x}", f"({upper} * i / {steps}.0)")
    return f"(SELECT sum({weight} * {at}) * {upper} / {steps}.0 / 3 FROM range(0, {steps + 1}) grid(i))"


def t_tail(t: str, df: str) -> str:
    front = f"exp(lgamma(({df} + 1) / 2.0) - lgamma({df} / 2.0)) / sqrt({df} * pi())"
    return f"1 - 2 * {front} * {simpson(f'pow(1 + {{x}} * {{x}} / {df}, -({df} + 1) / 2.0)', f'abs({t})')}"


def normal_tail(z: str) -> str:
    return f"CASE WHEN {z} <= 0 THEN 1.0 ELSE 1 - 2 * {simpson('exp(-{x} * {x} / 2)', z)} / sqrt(2 * pi()) END"


def f_tail(f: str, d1: str, d2: str) -> str:
    beta = f"lgamma({d1} / 2.0) + lgamma({d2} / 2.0) - lgamma(({d1} + {d2}) / 2.0)"
    density = (
        f"pow({{x}}, {d1} / 2.0 - 1) * exp({d1} / 2.0 * ln({d1}) + {d2} / 2.0 * ln({d2}) "
        f"- ({d1} + {d2}) / 2.0 * ln({d1} * {{x}} + {d2}) - ({beta}))"
    )
    return f"1 - {simpson(density, f)}"


def verdict(kind: str, stats: str, shown: str = "", **names) -> str:
    """Report row from a relation with ``statistic``, ``p`` and the shown numbers."""
    t = {k: v.format(**names) for k, v in fixed.TEST_TEXTS[kind].items()}
    reject = f"printf({lit(t['reject'])}, {shown})" if shown else lit(t["reject"])
    return f"""SELECT {lit(t['test'])} AS test, {lit(t['h0'])} AS null_hypothesis, {lit(t['h1'])} AS alternative_hypothesis,
      round(statistic, 4) AS statistic, abs(round(p, 6)) AS p_value, CAST(0.05 AS DOUBLE) AS alpha,
      CASE WHEN p < 0.05 THEN 'H0 rejeitada' ELSE 'H0 não rejeitada' END AS result,
      CASE WHEN p < 0.05 THEN {reject} ELSE {lit(t['keep'])} END AS interpretation FROM ({stats})"""


def corr_test(source: str, x: str, y: str, method: str) -> str:
    inner = f"SELECT r AS statistic, n, r * sqrt((n - 2) / (1 - r * r)) AS t FROM ({correlation(source, x, y, method)})"
    stats = f"SELECT statistic, {t_tail('t', '(n - 2)')} AS p FROM ({inner}) q"
    return verdict(method, stats, "statistic", x=x, y=y)


def welch(source: str, value: str, group: str, a: str, b: str) -> str:
    def side(g: str) -> str:
        return f"SELECT count({value}) AS n, avg({value}) AS m, var_samp({value}) AS v FROM {source} WHERE {group} = '{g}'"

    inner = f"""SELECT a.m AS ma, b.m AS mb, (a.m - b.m) / sqrt(a.v / a.n + b.v / b.n) AS statistic,
      pow(a.v / a.n + b.v / b.n, 2) / (pow(a.v / a.n, 2) / (a.n - 1) + pow(b.v / b.n, 2) / (b.n - 1)) AS df
      FROM ({side(a)}) a, ({side(b)}) b"""
    stats = f"SELECT statistic, ma, mb, {t_tail('statistic', 'df')} AS p FROM ({inner}) q"
    return verdict("welch", stats, "ma, mb", value=value, a=a, b=b)


def mann_whitney(source: str, value: str, group: str, a: str, b: str) -> str:
    rows = f"""SELECT {value} AS v, {group} = '{a}' AS in_a, rank() OVER (ORDER BY {value}) + (count(*) OVER (PARTITION BY {value}) - 1) / 2.0 AS r,
      count(*) OVER (PARTITION BY {value}) AS t FROM {source} WHERE {group} IN ('{a}', '{b}') AND {value} IS NOT NULL"""
    sums = f"""SELECT CAST(count(*) FILTER (in_a) AS DOUBLE) AS na, CAST(count(*) FILTER (NOT in_a) AS DOUBLE) AS nb,
      sum(r) FILTER (in_a) AS ra, sum(CAST(t AS DOUBLE) * t - 1) AS ties, median(v) FILTER (in_a) AS ma, median(v) FILTER (NOT in_a) AS mb
      FROM ({rows})"""
    u = f"""SELECT ma, mb, ra - na * (na + 1) / 2 AS statistic,
      (greatest(ra - na * (na + 1) / 2, na * nb - ra + na * (na + 1) / 2) - na * nb / 2 - 0.5)
      / sqrt(na * nb / 12 * (na + nb + 1 - ties / ((na + nb) * (na + nb - 1)))) AS z FROM ({sums})"""
    stats = f"SELECT statistic, ma, mb, {normal_tail('z')} AS p FROM ({u}) q"
    return verdict("mann_whitney", stats, "ma, mb", value=value, a=a, b=b)


def anova(source: str, value: str, group: str) -> str:
    groups = f"SELECT {group}, count({value}) AS n, avg({value}) AS m, var_samp({value}) AS v FROM {source} WHERE {group} IS NOT NULL GROUP BY {group} HAVING count({value}) > 1"
    sums = f"""SELECT CAST(count(*) - 1 AS DOUBLE) AS d1, CAST(sum(n) - count(*) AS DOUBLE) AS d2, sum(n * pow(m - g, 2)) AS b, sum((n - 1) * v) AS w
      FROM (SELECT *, sum(n * m) OVER () / sum(n) OVER () AS g FROM ({groups}))"""
    stats = f"SELECT statistic, {f_tail('statistic', 'd1', 'd2')} AS p FROM (SELECT *, (b / d1) / (w / d2) AS statistic FROM ({sums})) q"
    return verdict("anova", stats, value=value, group=group)


# --- fuzzy matching -----------------------------------------------------------------------


def sorted_tokens(c: str) -> str:
    return rf"array_to_string(list_sort(string_split({squeeze(c)}, ' ')), ' ')"


#: Longest common subsequence of (x, y) pairs: one recursion step per character of x,
#: the state is a row of the dynamic program.
LCS = """lcs AS (
  SELECT x, y, 0 AS i, list_transform(range(0, length(y) + 1), lambda k: 0) AS prev FROM pairs
  UNION ALL
  SELECT x, y, i + 1, list_reduce(range(1, length(y) + 1), lambda acc, j: list_append(acc,
           CASE WHEN x[i + 1] = y[j] THEN prev[j] + 1 ELSE greatest(acc[j], prev[j + 1]) END), [0])
  FROM lcs WHERE i < length(x)),
scored AS (
  SELECT x, y, CASE WHEN length(x) + length(y) = 0 THEN 100.0
    ELSE (1.0 - (length(x) + length(y) - 2 * prev[length(y) + 1]) / CAST(length(x) + length(y) AS DOUBLE)) * 100.0 END AS score
  FROM lcs WHERE i = length(x))"""


def fuzzy(source: str, id_column: str, column: str, threshold: float, before: str = "") -> str:
    return f"""WITH RECURSIVE {before}records AS (
  SELECT {id_column} AS id, {column} AS name, {key(column)} AS norm FROM {source} WHERE {column} IS NOT NULL),
keyed AS (SELECT id, name, left(norm, 1) AS block, {sorted_tokens('norm')} AS tokens FROM records),
members AS (SELECT DISTINCT block, tokens, id FROM keyed),
names AS (
  SELECT block, tokens, count(DISTINCT id) AS records, min({{'i': id, 'n': name}}) AS lo, max({{'i': id, 'n': name}}) AS hi
  FROM keyed GROUP BY block, tokens),
pairs AS (
  SELECT DISTINCT a.tokens AS x, b.tokens AS y FROM names a JOIN names b ON a.block = b.block AND a.tokens <> b.tokens
  AND (length(a.tokens) < length(b.tokens) OR (length(a.tokens) = length(b.tokens) AND a.tokens < b.tokens))),
{LCS},
found AS (
  SELECT a.block, a.tokens AS tokens_1, b.tokens AS tokens_2, a.lo AS r1, b.lo AS r2, a.records AS records_1,
         b.records AS records_2, c.n AS record_pairs, score
  FROM scored JOIN names a ON a.tokens = x JOIN names b ON b.tokens = y AND b.block = a.block
  JOIN (SELECT s.x AS tx, s.y AS ty, m.block AS bl, count(*) FILTER (m.id <> k.id) AS n FROM scored s
        JOIN members m ON m.tokens = s.x JOIN members k ON k.tokens = s.y AND k.block = m.block
        WHERE s.score >= {threshold} GROUP BY ALL) c ON tx = x AND ty = y AND bl = a.block
  WHERE score >= {threshold}
  UNION ALL
  SELECT block, tokens, tokens, lo, hi, records, records, CAST(records * (records - 1) / 2 AS BIGINT), 100.0 FROM names WHERE records > 1)
SELECT r1.i AS record_1, r2.i AS record_2, r1.n AS name_1, r2.n AS name_2, round(score, 2) AS similarity_score,
       true AS possible_duplicate, records_1, records_2, record_pairs, block, tokens_1, tokens_2 FROM found"""


def fuzzy_records(source: str, id_column: str, column: str, threshold: float, wanted: str, before: str = "") -> str:
    """Pairs of records (one name of each) behind the pairs of names that ``wanted`` picks."""
    base = fuzzy(source, id_column, column, threshold, before)
    return base[: base.rindex("SELECT r1.i AS record_1")].rstrip() + f""",
spelled AS (SELECT block, tokens, id, min(name) AS name FROM keyed GROUP BY ALL),
listed AS (
  SELECT m.id AS i, k.id AS j, m.name AS p, k.name AS q, score FROM found f
  JOIN spelled m ON m.block = f.block AND m.tokens = tokens_1 JOIN spelled k ON k.block = f.block AND k.tokens = tokens_2
  WHERE ({wanted}) AND (m.id < k.id OR (tokens_1 <> tokens_2 AND m.id <> k.id)))
SELECT least(i, j) AS record_1, greatest(i, j) AS record_2, CASE WHEN i < j THEN p ELSE q END AS name_1,
       CASE WHEN i < j THEN q ELSE p END AS name_2, round(score, 2) AS similarity_score, true AS possible_duplicate FROM listed"""


UNIQUE_PREFIX = f"{DIRTY},\n{CLEANED},\n{UNIQUE},\n"
