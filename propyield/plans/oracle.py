"""The analog tables and the engine's operators written as plain SQL for DuckDB.

These are the independent oracle for :mod:`propyield.plans.catalog`: the driver runs
each query's SQL on the same parquet tables (registered as views) and compares
results with the Spark DataFrame plan. Keep in step with ``analogs.py``.
"""

from __future__ import annotations

# The region of the checks, written out again: the SQL shares no parameter with the code.
REGION_CODE, REGION_LABELS = "3", ("['EUROPE']", "['ASIA']")

GEO_T = """geo_t AS (
  SELECT lpad(CAST(c.c_nationkey AS VARCHAR), 5, '0') AS postal,
         c.c_name AS commune,
         CAST(c.c_custkey AS VARCHAR) AS insee,
         n.n_name AS dep,
         '[''' || r.r_name || ''']' AS region_label,
         CAST(r.r_regionkey AS VARCHAR) AS region_code
  FROM customer c
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey)"""

SALE_T = """sale_t AS (
  SELECT CASE o.o_orderstatus WHEN 'F' THEN 'Vente' WHEN 'O' THEN 'Echange'
              ELSE 'Adjudication' END AS kind,
         lpad(CAST(c.c_nationkey AS VARCHAR), 5, '0') AS postal,
         CASE WHEN o.o_orderpriority = '5-LOW' THEN lower(c.c_name)
              ELSE c.c_name END AS commune,
         CASE WHEN l.l_returnflag = 'R' AND l.l_linestatus = 'F' THEN NULL
              WHEN l.l_returnflag = 'R' THEN ''
              WHEN l.l_returnflag = 'A' AND l.l_quantity < 5 THEN '0,00'
              ELSE replace(CAST(CAST(l.l_quantity AS DECIMAL(18,2)) AS VARCHAR), '.', ',')
         END AS surface_txt,
         CASE WHEN l.l_discount = CAST(0.10 AS DOUBLE) THEN 'NC'
              ELSE replace(CAST(CAST(l.l_extendedprice AS DECIMAL(18,2)) AS VARCHAR), '.', ',')
         END AS value_txt,
         o.o_orderpriority AS street_no,
         c.c_mktsegment AS street,
         CASE WHEN l.l_tax = CAST(0.08 AS DOUBLE) THEN strftime(o.o_orderdate, '%Y-%m-%d')
              ELSE strftime(o.o_orderdate, '%d/%m/%Y') END AS date_txt
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey)"""

RENT_T = """rent_t AS (
  SELECT CAST(c.c_custkey AS VARCHAR) AS insee,
         c.c_name AS city,
         CAST(n.n_regionkey AS VARCHAR) AS reg,
         n.n_name AS dep,
         replace(CAST(CAST(o.o_totalprice AS DECIMAL(18,2)) * 0.0001 AS VARCHAR), '.', ',') AS rent_txt,
         replace(CAST(CAST(o.o_totalprice AS DECIMAL(18,2)) * 0.00009 AS VARCHAR), '.', ',') AS low_txt,
         replace(CAST(CAST(o.o_totalprice AS DECIMAL(18,2)) * 0.00011 AS VARCHAR), '.', ',') AS high_txt,
         CAST(year(o.o_orderdate) AS VARCHAR) AS year
  FROM orders o
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey)"""


def labels_sql() -> str:
    return ", ".join("'" + lab.replace("'", "''") + "'" for lab in REGION_LABELS)


def num_sql(col: str, dtype: str = "DECIMAL(18,2)") -> str:
    return f"TRY_CAST(replace({col}, ',', '.') AS {dtype})"


def _yield(rent: str, surface: str, value: str) -> str:
    return (f"round((({rent} * CAST({surface} AS DOUBLE) * 12) "
            f"/ NULLIF(CAST({value} AS DOUBLE), 0)) * 100, 2)")


# --- derived steps (CTE bodies) ---

ADDRESS_KEYS_SQL = "s.street_no, s.street, s.postal, s.commune, s.date_txt, g.insee, g.dep"

# C-1 without the HAVING: kind, surface-present, region lookup join, address sums.
ADDRESS_NO_HAVING = f"""address_raw AS (
  SELECT {ADDRESS_KEYS_SQL},
         sum({num_sql('s.value_txt')}) AS value_sum,
         sum({num_sql('s.surface_txt')}) AS surface_sum
  FROM sale_t s
  JOIN (SELECT * FROM geo_t WHERE region_label IN ({labels_sql()})) g
    ON s.postal = g.postal AND s.commune = g.commune
  WHERE s.kind = 'Vente' AND s.surface_txt IS NOT NULL AND s.surface_txt <> ''
  GROUP BY {ADDRESS_KEYS_SQL})"""

ADDRESS = """address AS (
  SELECT * FROM address_raw WHERE surface_sum > 0)"""

RENT_PARSED = f"""rent_p AS (
  SELECT *, {num_sql('rent_txt', 'DECIMAL(18,8)')} AS rent_m2,
         {num_sql('low_txt', 'DECIMAL(18,8)')} AS rent_low_m2,
         {num_sql('high_txt', 'DECIMAL(18,8)')} AS rent_high_m2,
         TRY_CAST(year AS INTEGER) AS year_i
  FROM rent_t)"""


def rent_means_cte(name: str, keys: list[str], where: str = "") -> str:
    k = ", ".join(keys)
    cond = f"WHERE {where}" if where else ""
    return f"""{name} AS (
  SELECT {k}, year_i AS year,
         CAST(sum(rent_m2) AS DOUBLE) / count(rent_m2) AS avg_rent_m2,
         CAST(sum(rent_low_m2) AS DOUBLE) / count(rent_low_m2) AS avg_rent_low_m2,
         CAST(sum(rent_high_m2) AS DOUBLE) / count(rent_high_m2) AS avg_rent_high_m2
  FROM rent_p {cond}
  GROUP BY {k}, year_i)"""


def sales_totals_cte(name: str, key: str) -> str:
    return f"""{name} AS (
  SELECT {key}, year(try_strptime(date_txt, '%d/%m/%Y')) AS year,
         sum(surface_sum) AS total_surface,
         sum(value_sum) AS total_value
  FROM address
  GROUP BY {key}, year(try_strptime(date_txt, '%d/%m/%Y')))"""


YIELD_DEPT_LONG = f"""yield_dept AS (
  SELECT t.dep, CAST(t.year AS INTEGER) AS year,
         {_yield('r.avg_rent_m2', 't.total_surface', 't.total_value')} AS rental_yield
  FROM totals_dept t JOIN rent_dept r ON t.dep = r.dep AND t.year = r.year)"""

YIELD_CITY_LONG = f"""yield_city AS (
  SELECT r.city, t.insee, CAST(t.year AS INTEGER) AS year,
         {_yield('r.avg_rent_m2', 't.total_surface', 't.total_value')} AS rental_yield
  FROM totals_city t JOIN rent_city r ON t.insee = r.insee AND t.year = r.year)"""


# The sale years that find a rent in the test tables, written out: a PIVOT that looks for
# them itself cannot be made a view. A year the code loses or adds changes the columns.
YEARS = (1995, 1996, 1997, 1998, 1999, 2000, 2001)


def pivot_sql(source: str, keys: list[str], value: str = "rental_yield") -> str:
    """One column for each year."""
    return f"PIVOT {source} ON year IN {YEARS} USING max({value}) GROUP BY {', '.join(keys)}"


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def yield_chain(level: str) -> list[str]:
    """CTEs from the analogs up to the long yield table of ``level`` (dept|city)."""
    region = f"reg = '{REGION_CODE}'"
    if level == "dept":
        return [GEO_T, SALE_T, RENT_T, ADDRESS_NO_HAVING, ADDRESS, RENT_PARSED,
                rent_means_cte("rent_dept", ["dep"], region),
                sales_totals_cte("totals_dept", "dep"), YIELD_DEPT_LONG]
    return [GEO_T, SALE_T, RENT_T, ADDRESS_NO_HAVING, ADDRESS, RENT_PARSED,
            rent_means_cte("rent_city", ["city", "insee"], region),
            sales_totals_cte("totals_city", "insee"), YIELD_CITY_LONG]
