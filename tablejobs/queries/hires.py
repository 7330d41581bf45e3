"""Hire jobs without models."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tablejobs.plans import hires as plan
from tablejobs.queries import roles
from tablejobs.queries.registry import query
from tablejobs.queries.roles import roles_sql


@query(
    "hires_by_top_stations",
    roles_sql("""
    , top AS (SELECT start_station_name FROM hires WHERE start_date > TIMESTAMP '2024-01-10 00:00:00'
              GROUP BY start_station_name ORDER BY count(*) DESC, start_station_name LIMIT 3)
    SELECT start_station_name, count(*) AS nb_hires FROM hires
    WHERE start_date > TIMESTAMP '2024-01-10 00:00:00' AND start_station_name IN (SELECT start_station_name FROM top)
    GROUP BY start_station_name
    """),
)
def hires_by_top_stations(spark: SparkSession, sf: str) -> DataFrame:
    return plan.hires_by_top_stations(roles.hires(spark, sf), roles.HIRE_MOMENT)


@query(
    "avg_duration_listed_stations",
    roles_sql("""
    SELECT start_station_name, sum(duration::DECIMAL(28, 6))::DOUBLE / count(duration) AS avg_duration FROM hires
    WHERE upper(start_station_name) IN ('CLICK', 'SIGNUP') AND start_date > TIMESTAMP '2024-01-10 00:00:00'
    GROUP BY start_station_name
    """),
)
def avg_duration_listed_stations(spark: SparkSession, sf: str) -> DataFrame:
    return plan.avg_duration(roles.hires(spark, sf), ["CLICK", "SIGNUP"], roles.HIRE_MOMENT)


_HASH_SQL = """
, cells AS (SELECT id, CAST(floor((longitude + 180e0) / 360e0 * 32768) AS BIGINT) AS x,
                   CAST(floor((latitude + 90e0) / 180e0 * 32768) AS BIGINT) AS y FROM stations),
bits AS (SELECT id, CAST(sum(CASE WHEN i % 2 = 0 THEN ((x >> (14 - i // 2)) & 1) ELSE ((y >> (14 - i // 2)) & 1) END
                             * (1 << (4 - i % 5))) AS BIGINT) AS digit, i // 5 AS place
         FROM cells, range(30) r(i) GROUP BY id, i // 5),
hashes AS (SELECT id, string_agg(substr('0123456789bcdefghjkmnpqrstuvwxyz', digit + 1, 1), '' ORDER BY place) AS h
           FROM bits GROUP BY id)
"""


@query(
    "geo_cell_rollup",
    roles_sql(f"""{_HASH_SQL}
    SELECT h AS cell, count(*) AS nb_hires, sum(duration::DECIMAL(28, 6))::DOUBLE / count(duration) AS avg_duration
    FROM hires JOIN hashes ON start_station_id = id GROUP BY h
    UNION ALL SELECT substr(h, 1, 4), count(*), sum(duration::DECIMAL(28, 6))::DOUBLE / count(duration)
    FROM hires JOIN hashes ON start_station_id = id GROUP BY 1
    UNION ALL SELECT substr(h, 1, 2), count(*), sum(duration::DECIMAL(28, 6))::DOUBLE / count(duration)
    FROM hires JOIN hashes ON start_station_id = id GROUP BY 1
    """),
)
def geo_cell_rollup(spark: SparkSession, sf: str) -> DataFrame:
    return plan.geo_cell_rollup(roles.hires(spark, sf), roles.stations(spark, sf))
