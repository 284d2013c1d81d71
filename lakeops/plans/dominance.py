"""The flagship plan: star join, monthly places, dominance ranking, yearly series of the best."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.operators.aggregate import dominance
from lakeops.operators.topk import top_ranked
from lakeops.session import materialise
from lakeops.plans.roles import POINTS_SQL, race_points


def dominant_series(spark: SparkSession, sf_dir: str, top: int = 5, min_rows: int = 20) -> DataFrame:
    """Yearly points of the ``top`` nations by average points."""
    # ten rows per month: written once, then read by the ranking and by the series
    points = materialise(race_points(spark, sf_dir), "points")
    ranked = top_ranked(dominance(points, "n_name", "calculated_points", min_rows), ["-avg_points", "n_name"], top)
    best = ranked.select("n_name", F.col("rank").alias("team_rank"))
    # at most `top` rows by construction of the unique rank
    return (
        points.join(F.broadcast(best), "n_name")
        .groupBy("race_year", "n_name", "team_rank")
        .agg(
            F.count(F.lit(1)).alias("total_races"),
            F.sum("calculated_points").alias("total_points"),
            F.round(F.avg("calculated_points"), 6).alias("avg_points"),
        )
        .orderBy("race_year", F.col("avg_points").desc(), "n_name")
    )


DOMINANT_SERIES_SQL = f"""
WITH {POINTS_SQL},
teams AS (
  SELECT n_name, count(*) AS total_races, avg(calculated_points) AS avg_points FROM points
  GROUP BY n_name HAVING count(*) >= 20
),
best AS (SELECT n_name, rank() OVER (ORDER BY avg_points DESC, n_name) AS team_rank FROM teams)
SELECT p.race_year, p.n_name, b.team_rank, count(*) AS total_races,
       sum(calculated_points)::BIGINT AS total_points, round(avg(calculated_points), 6) AS avg_points
FROM points p JOIN best b ON p.n_name = b.n_name AND b.team_rank <= 5
GROUP BY p.race_year, p.n_name, b.team_rank
"""
