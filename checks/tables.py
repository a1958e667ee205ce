"""Input tables of the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Customer-like table with dirty text, derived from ``customer`` and ``orders``
#: by arithmetic both engines share. ``{customer}`` and ``{orders}`` name them.
DIRTY_CUSTOMERS = """
WITH o AS (
  SELECT o_custkey, count(*) AS n, sum(CAST(floor(o_totalprice) AS BIGINT)) AS spent,
         CAST(CAST(min(o_orderdate) AS DATE) AS STRING) AS d
  FROM {orders} GROUP BY o_custkey),
j AS (
  SELECT c_custkey AS k, 900 + CAST(floor(abs(c_acctbal)) AS BIGINT) AS inc,
         coalesce(n, 0) AS n, coalesce(spent, 0) AS spent, coalesce(d, '2001-03-04') AS d
  FROM {customer} LEFT JOIN o ON o_custkey = c_custkey),
b AS (
  SELECT k, inc, n, spent, substr(d,1,4) AS y, substr(d,6,2) AS m, substr(d,9,2) AS dd FROM j),
r AS (
  SELECT concat('CUST', lpad(CAST(k AS STRING), 6, '0')) AS customer_id,
    CASE k % 6 WHEN 0 THEN 'JOÃO SILVA' WHEN 1 THEN '  joao   silva ' WHEN 2 THEN 'Maria Souza'
               WHEN 3 THEN 'ana-maria ÁVILA' WHEN 4 THEN concat('Pedro Alves ', CAST(k % 17 AS STRING))
               ELSE 'silva joao' END AS customer_name,
    CASE WHEN k % 31 = 4 THEN 'sem-arroba.com' WHEN k % 4 = 0 THEN concat('USER', CAST(k AS STRING), '@EMAIL.COM')
         WHEN k % 4 = 1 THEN concat(' user', CAST(k AS STRING), '@email.com ')
         WHEN k % 4 = 2 THEN concat('user', CAST(k AS STRING), '@mail. com')
         ELSE concat('user', CAST(k AS STRING), '@mail.com') END AS email,
    CASE WHEN k % 10 = 3 THEN NULL WHEN k % 67 = 0 THEN '999' WHEN k % 67 = 1 THEN '-5'
         ELSE CAST(18 + (k * 7) % 60 AS STRING) END AS age,
    CASE k % 8 WHEN 0 THEN 'M' WHEN 1 THEN 'Masc' WHEN 2 THEN ' male' WHEN 3 THEN 'F' WHEN 4 THEN 'FEMININO'
               WHEN 5 THEN 'Não binário' WHEN 6 THEN 'xyz' ELSE NULL END AS gender,
    CASE WHEN k % 20 = 7 THEN NULL WHEN k % 2 = 0 THEN 'São Paulo' ELSE 'Curitiba' END AS city,
    CASE k % 9 WHEN 0 THEN 'SP' WHEN 1 THEN 'Sao Paulo' WHEN 2 THEN 'SÃO PAULO' WHEN 3 THEN 'RJ ' WHEN 4 THEN 'Paraná'
               WHEN 5 THEN 'pr' WHEN 6 THEN 'Goiás' WHEN 7 THEN 'Atlantis' ELSE NULL END AS state,
    CASE WHEN k % 97 = 5 THEN 'not a date' WHEN k % 4 = 0 THEN concat(y,'-',m,'-',dd) WHEN k % 4 = 1 THEN concat(dd,'/',m,'/',y)
         WHEN k % 4 = 2 THEN concat(dd,'-',m,'-',y) ELSE concat(y,'/',m,'/',dd) END AS signup_date,
    CASE WHEN k % 16 = 9 THEN NULL WHEN k % 3 = 0 THEN CAST(inc AS STRING)
         WHEN inc < 1000 THEN concat('R$ ', CAST(inc AS STRING), ',00')
         WHEN k % 3 = 1 THEN concat(CAST(CAST(floor(inc / 1000) AS BIGINT) AS STRING), '.', lpad(CAST(inc % 1000 AS STRING), 3, '0'))
         ELSE concat('R$ ', CAST(CAST(floor(inc / 1000) AS BIGINT) AS STRING), '.', lpad(CAST(inc % 1000 AS STRING), 3, '0'), ',50') END AS income,
    CASE WHEN k % 53 = 0 THEN '0' WHEN k % 120 = 11 THEN '800' ELSE CAST(n AS STRING) END AS purchase_count,
    CAST(spent AS STRING) AS total_spent,
    CASE WHEN k % 13 = 5 THEN NULL ELSE concat(CAST(1 + k % 4 AS STRING), '.', CAST(k % 10 AS STRING)) END AS satisfaction_score,
    k, y
  FROM b),
kept AS (
  SELECT customer_id, customer_name, email, age, gender, city, state, signup_date, income,
         purchase_count, total_spent, satisfaction_score, k FROM r),
copied AS (
  SELECT * FROM kept
  UNION ALL SELECT * FROM kept WHERE k % 50 = 0
  UNION ALL SELECT customer_id, customer_name, email, age, gender, city, state,
                   concat('2002-01-', lpad(CAST(1 + k % 28 AS STRING), 2, '0')), income,
                   purchase_count, total_spent, satisfaction_score, k FROM kept WHERE k % 40 = 1)
SELECT customer_id, customer_name, email, age, gender, city, state, signup_date, income,
       purchase_count, total_spent, satisfaction_score FROM copied
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dirty_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {name: table(spark, sf_dir, name) for name in ("customer", "orders")}
    return spark.sql(DIRTY_CUSTOMERS, **tables)


def dirty_customers_sql() -> str:
    return DIRTY_CUSTOMERS.format(customer="customer", orders="orders")


#: Amounts of lineitem written the ways people write them, right and wrong.
MESSY_NUMBERS = """
WITH c AS (
  SELECT l_orderkey, l_linenumber, l_partkey, CAST(round(l_extendedprice * 100) AS BIGINT) AS cents,
         CAST(floor(l_extendedprice) AS BIGINT) AS whole
  FROM {lineitem})
SELECT l_orderkey, l_linenumber,
  CASE (l_orderkey + l_linenumber + l_partkey) % 16
    WHEN 0 THEN CAST(whole AS STRING)
    WHEN 1 THEN concat('R$ ', CAST(whole AS STRING), ',', lpad(CAST(cents % 100 AS STRING), 2, '0'))
    WHEN 2 THEN concat(CAST(CAST(floor(whole / 1000) AS BIGINT) AS STRING), '.', lpad(CAST(whole % 1000 AS STRING), 3, '0'))
    WHEN 3 THEN concat('  R$', CAST(CAST(floor(whole / 1000) AS BIGINT) AS STRING), '.', lpad(CAST(whole % 1000 AS STRING), 3, '0'), ',5 ')
    WHEN 4 THEN concat(CAST(whole AS STRING), '.', lpad(CAST(cents % 100 AS STRING), 2, '0'))
    WHEN 5 THEN concat('0.', lpad(CAST(whole % 1000 AS STRING), 3, '0'))
    WHEN 6 THEN '1,234,567'
    WHEN 7 THEN concat('1.234.', CAST(cents % 100 AS STRING))
    WHEN 8 THEN concat('-', CAST(whole AS STRING), 'e2')
    WHEN 9 THEN concat(CAST(whole AS STRING), 'd')
    WHEN 10 THEN concat(CAST(whole % 10 AS STRING), '_000')
    WHEN 11 THEN 'nan'
    WHEN 12 THEN ' '
    WHEN 13 THEN concat('US$ ', CAST(whole AS STRING))
    WHEN 14 THEN concat(CAST(whole AS STRING), ' 000')
    ELSE NULL END AS amount
FROM c
"""


def messy_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(MESSY_NUMBERS, lineitem=table(spark, sf_dir, "lineitem"))


def messy_numbers_sql() -> str:
    return MESSY_NUMBERS.format(lineitem="lineitem")
