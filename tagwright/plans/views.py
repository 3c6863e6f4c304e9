"""Domain inputs derived from the star-schema tables by SQL that Spark and DuckDB both run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "catalog_raw": (("part",), """
SELECT p_partkey AS ord,
 CASE p_partkey % 3 WHEN 0 THEN upper(p_brand) WHEN 1 THEN lower(p_brand) ELSE ' ' || p_brand || ' ' END AS brand_raw,
 CASE WHEN p_size <= 25 THEN 'Ref' ELSE 'wm' END AS category_raw, p_type AS sub_raw,
 CASE WHEN p_partkey % 40 = 0 THEN cast(p_partkey AS string)
  ELSE 'R' || chr(cast(65 + p_size % 26 AS int)) || lpad(cast(p_partkey*7919 % 100000 AS string),5,'0')
       || chr(cast(65 + p_partkey % 26 AS int)) || lpad(cast(p_partkey*104729 % 1000 AS string),3,'0') || 'S'
       || CASE WHEN p_partkey % 10 = 0 THEN '/AE' ELSE '' END END AS code_raw
FROM part"""),
    "catalog_dup": (("catalog_raw",), """
SELECT * FROM catalog_raw
UNION ALL SELECT ord + 1000000, brand_raw, category_raw, sub_raw, code_raw FROM catalog_raw WHERE ord % 100 = 0
UNION ALL SELECT ord + 2000000, brand_raw, category_raw, sub_raw, replace(code_raw, '8', 'B') FROM catalog_raw WHERE ord % 50 = 3
UNION ALL SELECT ord + 3000000, CAST(NULL AS string), category_raw, CAST(NULL AS string), 'N' || code_raw FROM catalog_raw WHERE ord % 70 = 5"""),
    "catalog_clean": (("catalog_dup",), """
SELECT brand, category, sub, norm_code, split_part(norm_code,'/',1) AS stem, length(norm_code) AS code_len, ord FROM (
 SELECT *, row_number() OVER (PARTITION BY brand,category,sub,norm_code ORDER BY ord) AS rn FROM (
  SELECT coalesce(upper(trim(brand_raw)), '') AS brand, coalesce(upper(category_raw), '') AS category, coalesce(upper(sub_raw), '') AS sub,
         replace(upper(trim(code_raw)),' ','') AS norm_code, ord FROM catalog_dup) a) b WHERE rn = 1"""),
    "token_obs": (("lineitem", "catalog_raw"), """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
 CASE l_linenumber % 5 WHEN 0 THEN '(' || code_raw || ').' WHEN 1 THEN translate(code_raw,'05182','OSIBZ')
  WHEN 2 THEN substr(code_raw,1,length(code_raw)-1) WHEN 3 THEN lower(split_part(code_raw,'/',1)) || '/SG' ELSE 'X' || reverse(code_raw) END AS token
FROM lineitem JOIN catalog_raw ON l_partkey = ord"""),
    "price_obs": (("lineitem",), """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, rrp, d AS badge_raw, cast(floor(rrp*(100-d)/100) AS bigint) AS promo,
  CASE WHEN l_linenumber = 7 THEN cast(floor(rrp*(100-d)*97/10000) AS bigint) END AS member
FROM (SELECT *, cast(floor(l_extendedprice) AS bigint) AS rrp, cast(round(l_discount*100) AS bigint) AS d FROM lineitem) x"""),
    "price_text": (("price_obs",), """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, rrp,
 CASE l_partkey % 8 WHEN 0 THEN 'D' || cast(rrp AS string) WHEN 1 THEN cast(rrp AS string) || '.50'
  WHEN 2 THEN cast(rrp % 900 + 100 AS string) || ',' || lpad(cast(promo % 1000 AS string), 3, '0') WHEN 3 THEN '-' || cast(badge_raw AS string) || ' %'
  WHEN 4 THEN 'WASD' || cast(rrp % 90000 + 100 AS string) || '!' WHEN 5 THEN 'D' || cast(rrp % 9000 + 999 AS string) || 'E' || cast(promo % 9000 + 999 AS string)
  WHEN 6 THEN 'WORTHD' || cast(rrp AS string) ELSE 'now ' || cast(promo AS string) || '.25 was ' || cast(rrp AS string) || ' save ' || cast(badge_raw AS string) || '%' END AS text
FROM price_obs"""),
    "price_case": (("price_obs",), """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_partkey % 2 = 0 AS glyph,
 CASE WHEN l_partkey % 9 <> 6 THEN cast(rrp AS double) END AS p1,
 CASE l_partkey % 9 WHEN 2 THEN NULL WHEN 3 THEN NULL WHEN 5 THEN cast(floor(rrp / 10) AS double) WHEN 6 THEN NULL ELSE cast(promo AS double) END AS p2,
 CASE WHEN l_partkey % 9 IN (4, 8) THEN cast(floor(promo * 0.9) AS double) END AS p3,
 CASE WHEN l_partkey % 9 IN (1, 3, 8) THEN cast(badge_raw AS int) END AS pct,
 CASE WHEN l_partkey % 9 = 7 THEN cast(promo AS double) WHEN l_partkey % 18 = 6 THEN cast(rrp AS double) WHEN l_partkey % 18 = 4 THEN cast(floor(promo * 0.9) AS double) END AS m1
FROM price_obs"""),
    "file_obs": (("orders",), """
SELECT o_orderkey, o_custkey, o_orderdate,
 CASE o_custkey % 7 WHEN 0 THEN 'UAE' WHEN 1 THEN 'ksa' WHEN 2 THEN 'QTR' WHEN 3 THEN 'kuw' WHEN 4 THEN 'BAH' WHEN 5 THEN 'oman' ELSE 'Temporary' END
 || '_' || CASE o_custkey % 5 WHEN 0 THEN 'C4' WHEN 1 THEN 'LULU' WHEN 2 THEN 'SHARAF' WHEN 3 THEN 'EMAX' ELSE 'X' END
 || CASE WHEN o_orderkey % 4 = 3 THEN '' ELSE '_W' || lpad(cast(weekofyear(cast(o_orderdate AS date)) AS string),2,'0') END || '.pdf' AS source_file
FROM orders"""),
    "date_text": (("orders",), """
SELECT o_orderkey, cast(o_orderdate AS date) AS d0,
 CASE o_orderkey % 6 WHEN 0 THEN 'offer ' || cast(day(o_orderdate) AS string) || '/' || cast(month(o_orderdate) AS string) || '/' || cast(year(o_orderdate) AS string) || ' - 28/12/' || cast(year(o_orderdate) AS string)
  WHEN 1 THEN cast(day(o_orderdate) AS string) || '/' || cast(month(o_orderdate) AS string) || ' to 28/12/' || lpad(cast(year(o_orderdate) % 100 AS string), 2, '0')
  WHEN 2 THEN '1 January - ' || cast(day(o_orderdate) AS string) || ' March ' || cast(year(o_orderdate) AS string)
  WHEN 3 THEN '3 - ' || cast(day(o_orderdate) AS string) || ' Jul'
  WHEN 4 THEN '20 Dec till ' || cast(day(o_orderdate) % 9 + 1 AS string) || ' Jan, ' || cast(year(o_orderdate) AS string)
  ELSE 'no dates here' END AS text,
 CASE WHEN o_orderkey % 12 < 6 THEN year(o_orderdate) END AS year_hint
FROM orders"""),
    "tiles": (("price_obs",), """
SELECT page, slot, l_partkey, l_suppkey, rrp, promo, ((slot-1) % 3) * 500 AS cx, cast(floor((slot-1)/3) AS bigint) * 1300 AS ry FROM (
 SELECT l_orderkey AS page, l_partkey, l_suppkey, rrp, promo,
  cast(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, rrp) AS bigint) AS slot
 FROM price_obs) z"""),
    "box_obs": (("tiles",), """
SELECT page, slot, 'code' AS kind, cx + l_partkey % 60 AS x, ry + 900 AS y, l_partkey AS val, CAST(1.0 AS double) AS conf FROM tiles
UNION ALL SELECT page, slot, 'was', cx + 40 + l_suppkey % 80, ry + 60, rrp, CAST(0.95 AS double) FROM tiles
UNION ALL SELECT page, slot, 'now', cx + 40 + l_suppkey % 80, ry + 130, promo, CASE WHEN l_partkey % 11 = 0 THEN CAST(0.70 AS double) ELSE CAST(0.97 AS double) END FROM tiles
UNION ALL SELECT page, slot, 'chip', cx + 10 + l_partkey % 30, ry + 500, 200 + l_partkey % 500, CAST(0.99 AS double) FROM tiles WHERE l_partkey % 4 <> 0
UNION ALL SELECT page, slot, 'unit', cx + 10 + l_partkey % 30, ry + 540, l_partkey % 2, CAST(0.99 AS double) FROM tiles WHERE l_partkey % 4 <> 0
UNION ALL SELECT page, slot, 'member', cx + 60 + l_partkey % 300, ry + 140, 0, CAST(0.99 AS double) FROM tiles WHERE l_partkey % 6 = 0
UNION ALL SELECT page, slot, 'fin', cx + 60, ry + 150, 0, CAST(0.99 AS double) FROM tiles WHERE l_partkey % 9 = 0"""),
    "row_obs": (("price_obs", "part"), """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_partkey % 5 = 0 THEN '' ELSE 'R' || cast(l_partkey AS string) END AS matched_code,
 CASE WHEN l_partkey % 5 = 0 OR l_partkey % 17 = 0 THEN '' ELSE p_brand END AS brand, CASE WHEN p_size <= 25 THEN 'REF' ELSE 'WM' END AS category,
 CASE l_suppkey % 6 WHEN 0 THEN '' WHEN 1 THEN cast(l_partkey % 1400 AS string) || ' L' WHEN 2 THEN cast(l_partkey % 40 AS string) || ' kg' WHEN 3 THEN '8/5 kg' WHEN 4 THEN '550 L gross' ELSE CAST(NULL AS string) END AS capacity,
 CASE WHEN l_linenumber = 3 THEN NULL ELSE cast(rrp % 5000 AS double) END AS rrp, CASE WHEN l_linenumber = 5 THEN NULL ELSE cast(promo % 5000 AS double) END AS promo,
 CAST(badge_raw AS int) AS badge, CAST(0.97 AS double) AS confidence, CASE l_orderkey % 3 WHEN 0 THEN 'AED' WHEN 1 THEN 'KWD' ELSE '' END AS currency,
 'file' || cast(l_orderkey % 50 AS string) AS file, CASE WHEN l_orderkey % 11 = 0 THEN '' ELSE '2026-W' || lpad(cast(l_orderkey % 50 % 13 + 20 AS string), 2, '0') END AS year_week, l_partkey % 7 = 0 AS out_of_category
FROM price_obs JOIN part ON l_partkey = p_partkey"""),
    "ledger": (("events",), """
SELECT 'f' || cast(user_id AS string) AS file, CASE user_id % 4 WHEN 0 THEN 'failed' ELSE 'done' END AS status, count(*) AS n_rows
FROM events WHERE user_id % 3 <> 0 GROUP BY 1, 2"""),
    "word_pages": (("documents",), """
SELECT cast(doc_id % 97 AS string) AS file, cast(floor(doc_id / 97) + 1 AS int) AS page, text FROM documents"""),
}


def with_views(name: str, tables: dict[str, str] | None = None) -> str:
    """CTEs for a view and all that it needs. tables: what base tables are read from, where they are no views already."""
    done: list[str] = []
    ctes: list[str] = []

    def add(x: str) -> None:
        if x in done:
            return
        done.append(x)
        if x in VIEWS:
            for needed in VIEWS[x][0]:
                add(needed)
            ctes.append(f"{x} AS ({VIEWS[x][1]})")
        elif tables is not None:
            ctes.append(f"{x} AS (SELECT * FROM {tables[x]})")

    for x in name.split():
        add(x)
    return "WITH " + ",\n".join(ctes)


class _Tables(dict):
    def __init__(self, sf_dir: str):
        self.sf_dir = sf_dir

    def __missing__(self, name: str) -> str:
        return f"parquet.`{self.sf_dir}/{name}.parquet`"


def view(spark: SparkSession, sf_dir: str, name: str, select: str = "*") -> DataFrame:
    return spark.sql(f"{with_views(name, _Tables(sf_dir))}\nSELECT {select} FROM {name}")


def oracle(name: str, body: str) -> str:
    """SQL for DuckDB: the views, then a query over them. body may begin with further CTEs after a comma."""
    return f"{with_views(name)}{body if body.lstrip().startswith(',') else chr(10) + body}"
