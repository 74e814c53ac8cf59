"""A messy customer table derived from the supplied ``customer`` table.

The text is plain SQL that other engines read as well, so an oracle starts from the same rows.
Every customer has a place in each cycle of faults: ``k % 97 = 13`` leaves the id out, and so on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from veritide.sources.tables import text_view

MESSY_CUSTOMERS = """
keyed AS (
  SELECT CAST(c_custkey AS BIGINT) AS k, CAST(c_acctbal AS STRING) AS balance FROM customer
),
parts AS (
  SELECT k, balance,
    split_part('john,mary,alex,o''brien,mary-jane,PAT,lee,DeShawn,ann,bob', ',',
               CAST(k % 10 + 1 AS INT)) AS fn,
    split_part('doe,smith,lee,McDonald,o''neil,park,van dyke,shah,wu,li', ',',
               CAST((k * 7) % 10 + 1 AS INT)) AS ln,
    lpad(CAST(200 + (k * 17) % 800 AS STRING), 3, '0') AS area,
    lpad(CAST(200 + (k * 31) % 800 AS STRING), 3, '0') AS exchange,
    lpad(CAST((k * 7919) % 10000 AS STRING), 4, '0') AS line,
    CAST(1940 + k % 60 AS STRING) AS yy,
    lpad(CAST(k % 12 + 1 AS STRING), 2, '0') AS mm,
    lpad(CAST(k % 28 + 1 AS STRING), 2, '0') AS dd
  FROM keyed
),
customers_raw AS (
  SELECT k AS row_id,
    CASE WHEN k % 97 = 13 THEN '' WHEN k % 53 = 5 THEN CAST(k - 1 AS STRING)
         WHEN k % 211 = 9 THEN '0' ELSE CAST(k AS STRING) END AS customer_id,
    CASE WHEN k % 101 = 3 THEN '' WHEN k % 103 = 4 THEN 'J0hn' WHEN k % 107 = 5 THEN 'A'
         ELSE fn END AS first_name,
    CASE WHEN k % 109 = 6 THEN '   ' WHEN k % 113 = 7 THEN repeat('X', 60) ELSE ln END AS last_name,
    CASE WHEN k % 79 = 1 THEN '' WHEN k % 83 = 2 THEN 'not-an-email'
         WHEN k % 71 = 3 THEN 'user@nodot' WHEN k % 73 = 4 THEN '@no-local-part.com'
         ELSE concat(lower(fn), '.', CAST(k AS STRING), '@mail', CAST(k % 5 AS STRING),
                     '.example.com') END AS email,
    CASE WHEN k % 61 = 1 THEN '' WHEN k % 67 = 2 THEN '12345' WHEN k % 59 = 3 THEN 'phone-number'
         WHEN k % 6 = 1 THEN concat('(', area, ') ', exchange, '-', line)
         WHEN k % 6 = 2 THEN concat(area, '.', exchange, '.', line)
         WHEN k % 6 = 3 THEN concat(area, exchange, line)
         WHEN k % 6 = 4 THEN concat('+1 ', area, ' ', exchange, ' ', line)
         ELSE concat(area, '-', exchange, '-', line) END AS phone,
    CASE WHEN k % 47 = 1 THEN '' WHEN k % 43 = 2 THEN 'invalid_date'
         WHEN k % 41 = 3 THEN '1850-01-15' WHEN k % 37 = 4 THEN '2099-01-15'
         WHEN k % 31 = 5 THEN concat(mm, '/', dd, '/', yy)
         WHEN k % 29 = 6 THEN concat(dd, '-Mar-', yy)
         WHEN k % 23 = 7 THEN concat('25/', mm, '/', yy)
         ELSE concat(yy, '-', mm, '-', dd) END AS date_of_birth,
    CASE WHEN k % 127 = 1 THEN '' WHEN k % 131 = 2 THEN '1 A St'
         WHEN k % 137 = 3 THEN repeat('Long Road ', 30)
         ELSE concat(CAST(k AS STRING), ' Example Street, Town ', CAST(k % 90 AS STRING))
         END AS address,
    CASE WHEN k % 139 = 1 THEN '' WHEN k % 149 = 2 THEN '20000000.5' WHEN k % 151 = 3 THEN 'abc'
         ELSE balance END AS income,
    CASE WHEN k % 157 = 1 THEN '' WHEN k % 163 = 2 THEN 'Active' WHEN k % 167 = 3 THEN 'pending'
         WHEN k % 173 = 4 THEN 'N/A'
         ELSE split_part('active,inactive,suspended', ',', CAST(k % 3 + 1 AS INT))
         END AS account_status,
    CASE WHEN k % 179 = 1 THEN '' WHEN k % 181 = 2 THEN 'invalid_date'
         WHEN k % 19 = 3 THEN concat(mm, '/', dd, '/2015')
         ELSE concat('2015-', mm, '-', dd) END AS created_date
  FROM parts
)
"""


def messy_customers(spark: SparkSession, customer: DataFrame) -> DataFrame:
    """The messy table over the whole of ``customer``, as text with a row number."""
    sources = f"customer AS (SELECT * FROM {{customer}}), {MESSY_CUSTOMERS}"
    return text_view(spark.sql(f"WITH {sources} SELECT * FROM customers_raw", customer=customer))
