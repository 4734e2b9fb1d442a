"""Domain views over the driver's tables.

Each view is one SQL text that Spark and DuckDB both accept, with ``{table}`` marks for the source
tables. Spark runs it on the parquet DataFrames; the check SQL puts the same text in a WITH clause.
Missing values, "NA" texts and unmatched keys are made on purpose.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

SEASON = 2001  # the last year in the data plays "this season"

_UFN = "concat('U', l_orderkey, '-', l_linenumber, '-', l_partkey, '-', l_suppkey)"


def _ufn_where(condition: str) -> str:
    """The fish's key; rows that do not meet the condition have one that no fish has."""
    return f"concat(CASE WHEN {condition} THEN 'U' ELSE 'V' END, l_orderkey, '-', l_linenumber, '-', l_partkey, '-', l_suppkey)"


_SPECIES = (
    "CASE l_partkey % 5 WHEN 0 THEN 'SO' WHEN 1 THEN 'PI' WHEN 2 THEN 'CU' WHEN 3 THEN 'CO' ELSE 'HE' END"
)

VIEWS = {
    "sites": """
        SELECT n_nationkey AS site_id, n_name AS site_name,
               CASE WHEN n_regionkey IN (0, 1, 2) THEN 'DI' ELSE 'JS' END AS region,
               CASE n_regionkey % 3 WHEN 0 THEN 'C' WHEN 1 THEN 'E' ELSE 'W' END AS zone
        FROM {nation}""",
    "consistent_sites": "SELECT n_nationkey AS site_id FROM {nation} WHERE n_nationkey % 4 <> 1",
    "surveys": """
        SELECT o_orderkey AS survey_id, CAST(o_orderdate AS DATE) AS survey_date,
               CASE WHEN o_custkey % 29 = 0 THEN NULL ELSE o_custkey % 25 END AS site_id,
               concat('Crew ', o_custkey % 7, ', Crew ', 7 + o_orderkey % 5) AS crew
        FROM {orders}""",
    "seines": """
        SELECT o_orderkey * 10 AS seine_id, o_orderkey AS survey_id,
               CASE WHEN o_orderkey % 23 = 0 THEN NULL
                    ELSE o_custkey % 60 - 10 * (CASE WHEN o_custkey % 60 >= 10 THEN 1 ELSE 0 END) END AS so_total,
               o_custkey % 41 AS pi_total,
               CASE WHEN o_orderkey % 31 = 0 THEN NULL ELSE o_custkey % 37 END AS cu_total,
               o_custkey % 11 AS co_total, o_custkey % 97 AS he_total, o_custkey % 5 AS ck_total
        FROM {orders} WHERE o_orderkey % 13 <> 0
        UNION ALL
        SELECT o_orderkey * 10 + 1, o_orderkey, o_custkey % 19, o_custkey % 7,
               CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_custkey % 3 END,
               o_custkey % 2, o_custkey % 5, o_custkey % 3
        FROM {orders} WHERE o_orderkey % 17 = 0 AND o_orderkey % 13 <> 0""",
    "fish": f"""
        SELECT {_UFN} AS ufn, l_orderkey * 10 AS seine_id, {_SPECIES} AS species,
               CASE WHEN l_suppkey % 19 = 0 THEN 'NA'
                    ELSE CAST(60 + (l_partkey * 7 + l_linenumber) % 100 AS STRING) END AS fork_length_field,
               1 + l_quantity AS weight,
               CASE l_suppkey % 7 WHEN 0 THEN 'NA' WHEN 1 THEN 'P' WHEN 2 THEN 'P' ELSE 'A' END AS lice_presence,
               CASE WHEN l_suppkey % 11 < 8 THEN 'presence/absence' ELSE 'counts' END AS field_lice_id_protocol
        FROM {{lineitem}}""",
    "fish_lab": f"""
        SELECT {_ufn_where("l_suppkey % 3 = 0")} AS ufn, CAST(61 + l_partkey % 99 AS DOUBLE) AS fork_length
        FROM {{lineitem}}""",
    "lice": f"""
        SELECT {_ufn_where("l_partkey % 6 <> 0")} AS ufn, l_orderkey * 10 AS seine_id,
               CASE WHEN l_suppkey % 43 = 0 THEN NULL ELSE l_partkey % 2 END AS lep_cope,
               l_partkey % 3 AS lam, l_suppkey % 2 AS laf, l_suppkey % 4 AS lgf, l_partkey % 4 AS cal_cope,
               l_partkey % 5 AS cam, l_suppkey % 3 AS caf, l_suppkey % 5 AS cgf,
               l_linenumber % 3 AS chal_a_b, l_linenumber % 2 AS unid_cope, l_partkey % 2 AS unid_chal
        FROM {{lineitem}}""",
    "lice_2018": f"""
        SELECT {_UFN} AS ufn, l_orderkey * 10 AS seine_id, {_SPECIES} AS species,
               l_partkey % 2 AS cal_cope, l_suppkey % 2 AS lep_cope, l_linenumber % 3 AS chal_a,
               CASE WHEN l_suppkey % 41 = 0 THEN NULL ELSE l_linenumber % 2 END AS chal_b,
               (l_partkey % 3) div 2 AS cm, 0 AS cpaf, (l_suppkey % 3) div 2 AS caf, (l_suppkey % 4) div 3 AS cgf,
               (l_partkey % 4) div 3 AS lpam, 0 AS lpaf,
               CASE WHEN l_partkey % 47 = 0 THEN NULL ELSE (l_partkey % 6) div 5 END AS lam,
               (l_suppkey % 5) div 4 AS laf, (l_linenumber % 4) div 3 AS lgf,
               l_linenumber % 2 AS unid_cope, l_partkey % 2 AS unid_chal
        FROM {{lineitem}}""",
    "lice_lab": f"""
        SELECT {_ufn_where("l_partkey % 4 = 1")} AS ufn,
               CASE WHEN l_suppkey % 13 = 0 THEN NULL ELSE l_partkey % 2 END AS lep_cop,
               CASE WHEN l_suppkey % 13 = 0 THEN NULL ELSE l_suppkey % 2 END AS lep_chal_a,
               CASE WHEN l_suppkey % 13 = 0 THEN NULL ELSE l_linenumber % 2 END AS lep_chal_b,
               l_partkey % 3 AS lep_a_m, l_suppkey % 3 AS lep_grav_f,
               CASE WHEN l_partkey % 17 = 0 THEN NULL ELSE l_partkey % 4 END AS cal_cop,
               l_suppkey % 4 AS cal_chal_a_1, l_linenumber % 3 AS cal_chal_b_3, l_partkey % 5 AS cal_mot_unid
        FROM {{lineitem}}""",
    "lice_field": f"""
        SELECT {_ufn_where("l_partkey % 8 IN (1, 2, 3)")} AS ufn,
               CASE WHEN l_suppkey % 37 = 0 THEN NULL ELSE l_partkey % 3 END AS cal_cope_field,
               l_suppkey % 2 AS lep_cope_field, l_linenumber % 2 AS chal_a_field,
               CASE WHEN l_partkey % 53 = 0 THEN NULL ELSE l_linenumber % 3 END AS chal_b_field,
               l_partkey % 2 AS lpam_field, l_suppkey % 3 AS lpaf_field, l_partkey % 4 AS lam_field,
               l_suppkey % 4 AS laf_field, l_linenumber % 2 AS lgf_field, l_partkey % 5 AS cal_mot_field,
               l_suppkey % 5 AS cgf_field, l_partkey % 2 AS unid_cope_field, l_suppkey % 2 AS unid_chal_field
        FROM {{lineitem}}""",
    "lice_series": f"""
        SELECT {_ufn_where("l_partkey % 3 = 0")} AS ufn, CAST(l_shipdate AS DATE) AS survey_date,
               CASE WHEN l_linenumber = 7 THEN year(CAST(l_shipdate AS DATE)) + 1
                    ELSE year(CAST(l_shipdate AS DATE)) END AS year,
               CASE WHEN l_suppkey % 3 = 0 THEN 'JS' ELSE 'DI' END AS region, {_SPECIES} AS species,
               CASE l_linenumber % 3 WHEN 0 THEN 'all_lice' WHEN 1 THEN 'motile_caligus' ELSE 'motile_lep' END
                   AS louse_species,
               CASE WHEN l_suppkey % 31 = 0 THEN NULL ELSE l_partkey % 6 END AS n_lice
        FROM {{lineitem}}""",
    "ctd": """
        SELECT CASE l_suppkey % 4 WHEN 0 THEN 'QU39' WHEN 1 THEN 'QU29' WHEN 2 THEN 'JS2' ELSE 'JS12' END AS station,
               CAST(l_shipdate AS DATE) AS date, l_linenumber AS cast_number, l_quantity AS depth,
               6 + 20 * l_discount + dayofyear(CAST(l_shipdate AS DATE)) / CAST(40 AS DOUBLE) AS temperature,
               27 + 20 * l_tax AS salinity,
               CASE WHEN l_partkey % 37 = 0 THEN NULL ELSE 4 + l_tax * 30 END AS dissolved_oxygen_ml_l
        FROM {lineitem}""",
    "casts": """
        SELECT CASE l_suppkey % 4 WHEN 0 THEN 'QU39' WHEN 1 THEN 'QU29' WHEN 2 THEN 'JS2' ELSE 'JS12' END AS station,
               CAST(l_shipdate AS DATE) AS date, l_linenumber AS cast_number, min(l_orderkey) AS survey_id
        FROM {lineitem} WHERE l_linenumber < 7 GROUP BY 1, 2, 3""",
    "ctd_2017": """
        SELECT concat('SBE', l_suppkey % 9, '_', CAST(CAST(l_shipdate AS DATE) AS STRING), '_1', l_linenumber, '_30')
                   AS filename,
               CASE WHEN l_suppkey % 4 < 2 THEN 'DI' ELSE 'JS' END AS region, l_quantity AS depth,
               CASE WHEN l_partkey % 61 = 0 THEN NULL ELSE 6 + 20 * l_discount END AS temperature,
               CASE WHEN l_partkey % 89 = 0 THEN NULL ELSE 1 + 40 * l_tax END AS chlorophyll
        FROM {lineitem}""",
    "chl": """
        SELECT CAST(l_shipdate AS DATE) AS date,
               CASE l_suppkey % 4 WHEN 0 THEN 'QU39' WHEN 1 THEN 'QU29' WHEN 2 THEN 'JS2' ELSE 'JS12' END AS site_id,
               CASE WHEN l_linenumber % 2 = 0 THEN 'Bulk GF/F' ELSE '20um' END AS filter_type,
               l_quantity AS line_out_depth,
               CASE WHEN l_partkey % 41 = 0 THEN NULL ELSE 100 * l_discount + l_linenumber / CAST(8 AS DOUBLE) END
                   AS chla
        FROM {lineitem}""",
    "chl_sites": "SELECT 'QU39' AS site_id UNION ALL SELECT 'QU29'",
    "wind": """
        SELECT CAST(o_orderdate AS DATE) AS date, month(CAST(o_orderdate AS DATE)) AS month,
               (o_orderkey * 13 % 1200) / CAST(100 AS DOUBLE) AS wind_spd,
               CASE WHEN o_custkey % 53 = 0 THEN NULL ELSE (o_orderkey * 37 % 3601) / CAST(10 AS DOUBLE) END
                   AS wind_dir
        FROM {orders}""",
    "wind_speed": """
        SELECT concat(CAST(CAST(o_orderdate AS DATE) AS STRING), CASE WHEN o_orderkey % 19 <> 0 THEN ' 0' ELSE ' 1' END,
                      o_orderkey % 10, ':00 #', o_orderkey) AS stamp,
               year(CAST(o_orderdate AS DATE)) AS year, month(CAST(o_orderdate AS DATE)) AS month,
               (o_orderkey * 13 % 1200) / CAST(100 AS DOUBLE) AS wind_spd
        FROM {orders}""",
    "wind_direction": """
        SELECT concat(CAST(CAST(o_orderdate AS DATE) AS STRING), ' 0', o_orderkey % 10, ':00 #', o_orderkey) AS stamp,
               year(CAST(o_orderdate AS DATE)) AS year, month(CAST(o_orderdate AS DATE)) AS month,
               CASE WHEN o_custkey % 53 = 0 THEN NULL ELSE (o_orderkey * 37 % 3601) / CAST(10 AS DOUBLE) END
                   AS wind_dir
        FROM {orders}""",
    "sst": """
        SELECT event_type AS survey, CAST(ts AS DATE) AS date,
               CASE WHEN event_id % 997 = 0 THEN NULL ELSE value / CAST(30 AS DOUBLE) END AS temp
        FROM {events}""",
    "secchi": """
        SELECT CAST(ts AS DATE) AS date, event_id, value / CAST(10 AS DOUBLE) AS line_out_depth FROM {events}
        UNION ALL
        SELECT CAST(o_orderdate AS DATE), o_orderkey, (o_custkey % 200) / CAST(10 AS DOUBLE) FROM {orders}""",
}

_MARK = re.compile(r"\{(\w+)\}")


def views(spark: SparkSession, sf_dir: str, names: Iterable[str]) -> list[DataFrame]:
    """The named views; each source table is opened once for all of them."""
    tables: dict[str, DataFrame] = {}
    out = []
    for text in (VIEWS[n] for n in names):
        used = set(_MARK.findall(text))
        for t in used - tables.keys():
            tables[t] = spark.read.parquet(f"{sf_dir}/{t}.parquet")
        out.append(spark.sql(text, **{t: tables[t] for t in used}))
    return out


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return views(spark, sf_dir, [name])[0]


def with_views(*names: str) -> list[str]:
    """The views as common table expressions for DuckDB."""
    return [f"{n} AS ({_MARK.sub(lambda m: m.group(1), VIEWS[n])})".replace(" div ", " // ") for n in names]
