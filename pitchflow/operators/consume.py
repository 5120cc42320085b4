"""Consumption queries over the Gold tables.

They answer the questions the Gold tables are documented to serve. Inputs
are already aggregated (season x team [x role]), so windows partitioned by
team work on a few rows per team and season. Ranks over all rows are counted in blocks.
A ranking returns every row with its rank; ``k`` keeps the ranks up to k where
the caller wants a top-k report.
"""

from __future__ import annotations

from functools import reduce
from itertools import accumulate
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from pitchflow import spec
from pitchflow.operators.gold import played, team_view
from pitchflow.session import new_run_dir


def _ranked(df: DataFrame, order: list[str], k: int | None) -> DataFrame:
    """``puesto`` (rank by ``order``, each descending, NULLs last) in front of the rows; ties share a rank.

    No task sees all rows. They are written once in blocks by range, equal rows spread
    by their other columns too. A rank is one more than the rows before it: those of the
    blocks before (one number per block, at most ``spark.sql.shuffle.partitions``, added up at the driver) and those
    before it in the block where its values first occur, counted over different values only.
    """
    spark = df.sparkSession
    by = [F.col(c).desc() for c in order]
    path = new_run_dir(spark, "puestos")
    dealt = df.repartitionByRange(*by, *[F.col(c) for c in df.columns if c not in order])
    dealt.withColumn("_bloque", F.spark_partition_id()).write.parquet(path)
    rows = spark.read.schema(StructType([*dealt.schema.fields, StructField("_bloque", IntegerType())])).parquet(path)
    values = rows.groupBy(*order).agg(F.count(F.lit(1)).alias("_n"), F.min("_bloque").alias("_bloque"))
    sizes = {r["_bloque"]: r["n"] for r in values.groupBy("_bloque").agg(F.sum("_n").alias("n")).collect()}
    blocks = sorted(sizes)
    starts = [(b, total - sizes[b]) for b, total in zip(blocks, accumulate(sizes[b] for b in blocks), strict=True)]
    offsets = spark.createDataFrame(starts, "_bloque int, _antes long")
    here = Window.partitionBy("_bloque").orderBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    ranks = values.select(*order, "_bloque", F.coalesce(F.sum("_n").over(here), F.lit(0)).alias("_previas"))
    ranks = ranks.join(F.broadcast(offsets), "_bloque").select(
        *[F.col(c).alias(f"_{c}") for c in order], (F.col("_antes") + F.col("_previas") + 1).cast("int").alias("puesto")
    )
    if k is not None:
        ranks = ranks.filter(F.col("puesto") <= k)
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in order])
    return rows.join(ranks, same).select("puesto", *df.columns)


def season_table(standings: DataFrame, season: int | None = None) -> DataFrame:
    """Final standings of each season (or of one), in table order.

    With a season, the filter on the rank's partition column is pushed
    below the window and the aggregate, down to the scan side.
    """
    if season is not None:
        standings = standings.filter(F.col("temporada") == F.lit(season))
    return standings.select(
        "temporada", "posicion", "equipo", "partidos_jugados", "victorias", "empates",
        "derrotas", "goles_favor", "goles_contra", "diferencia_goles", "puntos",
    ).orderBy("temporada", "posicion", "equipo")


def all_time_points(standings: DataFrame, k: int | None = None) -> DataFrame:
    """Teams by points (then goal difference) over all seasons."""
    totals = standings.groupBy("equipo").agg(
        F.sum("puntos").alias("puntos_totales"),
        F.sum("diferencia_goles").alias("diferencia_goles_total"),
        F.sum("partidos_jugados").alias("partidos_jugados"),
        F.count(F.lit(1)).alias("temporadas"),
    )
    return _ranked(totals, ["puntos_totales", "diferencia_goles_total"], k)


def season_record(standings: DataFrame) -> DataFrame:
    """Wins, draws and losses per team and season."""
    return standings.select(
        "temporada", "equipo", "partidos_jugados", "victorias", "empates", "derrotas"
    )


def team_evolution(standings: DataFrame) -> DataFrame:
    """C4: each team's points and position season over season."""
    by_team = Window.partitionBy("equipo").orderBy("temporada")
    prev_points = F.lag("puntos").over(by_team)
    prev_pos = F.lag("posicion").over(by_team)
    return standings.select(
        "equipo",
        "temporada",
        "puntos",
        "posicion",
        prev_points.alias("puntos_anterior"),
        (F.col("puntos") - prev_points).alias("variacion_puntos"),
        prev_pos.alias("posicion_anterior"),
        (prev_pos - F.col("posicion")).alias("mejora_posicion"),
    )


HOME_AWAY_MEASURES = [
    "partidos_jugados",
    "puntos",
    "goles_favor",
    "goles_contra",
    "posesion_promedio",
    "disparos_puerta_promedio",
]


def home_vs_away(performance: DataFrame) -> DataFrame:
    """Home and away side by side, one row per team and season.

    Pivot on the two known role values, so Spark skips the distinct pass it
    runs for an open pivot.
    """
    return (
        performance.groupBy("temporada", "equipo")
        .pivot("rol", [spec.SIDE_HOME, spec.SIDE_AWAY])
        .agg(*[F.max(m).alias(m) for m in HOME_AWAY_MEASURES])
    )


def possession_and_accuracy(
    silver: DataFrame, k: int | None = None, start_year: int = spec.PERFORMANCE_START_YEAR
) -> DataFrame:
    """Season, team and role by possession, then shooting accuracy (on target / total shots).

    From Silver match rows: a ratio of the rounded Gold averages would swap near ranks.
    """
    recent = played(silver).filter(F.col("temporada") >= F.lit(start_year))
    teams = team_view(recent, ["posesion", "disparos_puerta", "tiros_totales"])
    sums = teams.groupBy("temporada", "equipo", "rol").agg(
        F.avg("posesion").alias("posesion_promedio"),
        F.try_divide(F.sum("disparos_puerta"), F.sum("tiros_totales")).alias("precision_tiro"),
    )
    return _ranked(sums, ["posesion_promedio", "precision_tiro"], k)


def shots_on_target_evolution(performance: DataFrame) -> DataFrame:
    """Average shots on target per team and role, with the change from the season before."""
    by_team_role = Window.partitionBy("equipo", "rol").orderBy("temporada")
    prev = F.lag("disparos_puerta_promedio").over(by_team_role)
    return performance.select(
        "equipo",
        "rol",
        "temporada",
        "disparos_puerta_promedio",
        prev.alias("disparos_puerta_anterior"),
        (F.col("disparos_puerta_promedio") - prev).alias("variacion"),
    )


def away_fouls(performance: DataFrame, k: int | None = None) -> DataFrame:
    """Teams by fouls when playing away."""
    away = performance.filter(F.col("rol") == F.lit(spec.SIDE_AWAY)).select(
        "temporada", "equipo", "faltas_promedio", "tarjetas_amarillas_promedio", "tarjetas_rojas_promedio"
    )
    return _ranked(away, ["faltas_promedio"], k)


def fouls_and_cards(silver: DataFrame, k: int | None = None) -> DataFrame:
    """Season and team by fouls, then cards, per match.

    Computed from Silver match rows, not from Gold averages: the Gold
    ``partidos_jugados`` also counts matches without statistics, so
    weighting its averages by it would be wrong. A team without statistics has
    NULL averages and ranks last.
    """
    teams = team_view(played(silver), ["faltas", "tarjetas_amarillas", "tarjetas_rojas"])
    cards = F.col("tarjetas_amarillas") + F.col("tarjetas_rojas")
    sums = teams.groupBy("temporada", "equipo").agg(
        F.count("faltas").alias("partidos_con_estadisticas"),
        F.avg("faltas").alias("faltas_por_partido"),
        F.avg(cards).alias("tarjetas_por_partido"),
    )
    return _ranked(sums, ["faltas_por_partido", "tarjetas_por_partido"], k)
