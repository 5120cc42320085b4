"""Registered queries: name -> (callable(spark, sf_dir) -> DataFrame, oracle SQL or None).

Every query starts from the given ``orders`` table (through the synthetic
match fixture), so its work grows with the data. Audit columns whose values
cannot be reproduced outside the run (load time, file paths) are left out of
the compared projections.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchflow import spec
from pitchflow.functions.names import sanitized
from pitchflow.operators import consume, gold, quality, silver
from pitchflow.operators.columns import rename_columns, sanitize_column_names
from pitchflow.plans import oracle
from pitchflow.plans import layers
from pitchflow.session import new_run_dir
from pitchflow.sources import landing
from pitchflow.sources.fixture import DOCUMENTS_PER_FILE, ORDER_KEY, documents_made_of, raw_matches, read_orders, season_documents, write_documents
from pitchflow.streaming.bronze import ingest_landing, read_bronze, read_quarantine, replay_quarantine

QueryFn = Callable[[SparkSession, str], DataFrame]

MATCHES_PER_DOCUMENT = 5000  # a landing document covers this many order keys of one season
COMPRESSION = "lz4"  # of landing files: their field names repeat in every match
FIRST_DROP_LAST_SEASON = 2021  # the stream test lands seasons up to here first, the rest later


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_matches(read_orders(spark, sf_dir))


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.silver_matches(_raw(spark, sf_dir))


def _standings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.standings(_silver(spark, sf_dir))


def _performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.team_performance(_silver(spark, sf_dir))


def _unified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.unify_languages(sanitize_column_names(_raw(spark, sf_dir)))


def _no_audit(df: DataFrame) -> DataFrame:
    return df.drop(*spec.AUDIT_RENAMES.values())


# --- Bronze -----------------------------------------------------------------


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return season_documents(read_orders(spark, sf_dir), MATCHES_PER_DOCUMENT)


def _land(docs: DataFrame, path: str, **layout: bool) -> str:
    return write_documents(docs, path, compression=COMPRESSION, **layout)


def q_bronze_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON Lines landing, typed schema inference, explode + flatten."""
    run = new_run_dir(spark, "bronze_explode")
    _land(_documents(spark, sf_dir), f"{run}/landing")
    docs = landing.read_documents(spark, f"{run}/landing", infer_types=True)
    return landing.explode_matches(docs, lineage=False)


def _date_back(spark: SparkSession, files: str, days: int) -> None:
    """Set the modification time of the files to ``days`` ago, as a copy that keeps dates would."""
    pattern = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(files)
    store = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    at = int((time.time() - days * 86_400) * 1000)
    for s in store.globStatus(pattern) or []:
        store.setTimes(s.getPath(), at, -1)


def q_bronze_stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three incremental runs.

    Run 1 ingests the seasons up to 2021 (base and Spanish fields); run 2
    lands the later seasons, whose English fields are new columns, in files
    dated 30 days back; run 3 finds no new file and must add nothing.
    """
    run = new_run_dir(spark, "bronze_stream")
    docs = _documents(spark, sf_dir)
    files = f"{run}/landing/*/*.json.lz4"
    bronze, state = f"{run}/bronze", f"{run}/state"
    _land(docs.filter(F.col("temporada") <= FIRST_DROP_LAST_SEASON), f"{run}/landing/drop1")
    ingest_landing(spark, files, bronze, state)
    _land(docs.filter(F.col("temporada") > FIRST_DROP_LAST_SEASON), f"{run}/landing/drop2")
    _date_back(spark, f"{run}/landing/drop2/*.json.lz4", 30)
    ingest_landing(spark, files, bronze, state)
    known = ingest_landing(spark, files, bronze, state).schema
    return read_bronze(spark, bronze, known).drop(spec.SOURCE_FILE_COL, spec.LOAD_TIME_COL)


def q_bronze_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Multi-line layout, one document per file, with file lineage and load time."""
    run = new_run_dir(spark, "bronze_lineage")
    written = _documents(spark, sf_dir)
    _land(written, f"{run}/landing", one_document_per_file=True)
    schema = landing.as_stored(written.drop("doc").schema)
    docs = landing.read_documents(spark, f"{run}/landing/*/*.json.lz4", schema, multi_line=True)
    rows = landing.to_bronze(docs)
    name = F.regexp_extract(spec.SOURCE_FILE_COL, r"/doc=([^/]+)/[^/]+\.json\.lz4$", 1)
    return rows.groupBy("temporada", name.alias("documento")).agg(
        F.count(F.lit(1)).alias("partidos"),
        F.count(spec.LOAD_TIME_COL).alias("con_hora_de_carga"),
    )


def q_bronze_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A drop with one broken document per season: rows kept, and texts set aside."""
    run = new_run_dir(spark, "bronze_quarantine")
    docs = _documents(spark, sf_dir)
    _land(docs, f"{run}/landing/good")
    cut_off = F.concat(F.lit('{"temporada": '), F.col("temporada").cast("string"), F.lit(', "data": [{"local": "tea'))
    docs.select("temporada").distinct().select(cut_off.alias("value")).write.option("compression", COMPRESSION).text(f"{run}/landing/broken")
    known = ingest_landing(spark, f"{run}/landing/*/*", f"{run}/bronze", f"{run}/state").schema
    kept = read_bronze(spark, f"{run}/bronze", known).groupBy("temporada").agg(F.count(F.lit(1)).alias("partidos"))
    season = F.regexp_extract("value", r'"temporada": (\d+)', 1).alias("temporada")
    aside = read_quarantine(spark, f"{run}/bronze").groupBy(season).agg(F.count(F.lit(1)).alias("apartados"))
    return kept.join(aside, "temporada", "full").select("temporada", "partidos", "apartados")


def q_bronze_rescue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two drops in which stray texts stand between the matches, single matches and texts in the
    place of the list, and a field has the season's name: matches kept, values rescued and set aside (S3, P1)."""
    run = new_run_dir(spark, "bronze_rescue")
    orders, k = read_orders(spark, sf_dir), F.col(ORDER_KEY)
    raw = raw_matches(orders, keep_key=True)

    def match(key: Column, fields: list[Column]) -> Column:
        return F.to_json(F.struct(*fields, F.when(key % 7 == 0, F.lit("x")).alias("Temporada")))

    def element(key: Column, season: Column, fields: list[Column]) -> Column:
        stray = F.when(key % 10 == 1, F.concat(F.lit(', "suelto '), season.cast("string"), F.lit('"'))).otherwise("")
        return F.concat(match(key, fields), stray)

    fields = [F.col(f"`{c}`") for c in raw.columns if c not in (ORDER_KEY, "temporada")]
    rows = raw.select("temporada", k, match(k, fields).alias("match"))

    def document(data: Column) -> Column:
        return F.concat(F.lit('{"temporada": '), F.col("temporada").cast("string"), F.lit(', "data": '), data, F.lit("}")).alias("value")

    listed = documents_made_of(orders.where(k % 100 != 0), element, MATCHES_PER_DOCUMENT)
    parts = [
        listed.select("temporada", document(F.concat(F.lit("["), F.array_join(spec.DATA_FIELD, ", "), F.lit("]")))),
        rows.where(k % 100 == 0).select("temporada", document(F.col("match"))),
        rows.select("temporada").distinct().select("temporada", document(F.concat(F.lit('"sin datos '), F.col("temporada").cast("string"), F.lit('"')))),
    ]
    bronze, state = f"{run}/bronze", f"{run}/state"
    first = F.col("temporada") <= FIRST_DROP_LAST_SEASON
    for drop, chosen in (("drop1", first), ("drop2", ~F.coalesce(first, F.lit(False)))):
        for i, part in enumerate(parts):
            most = 0 if i else DOCUMENTS_PER_FILE  # the others are small documents
            writer = part.where(chosen).select("value").write.option("compression", COMPRESSION).option("maxRecordsPerFile", most)
            writer.text(f"{run}/landing/{drop}_{i}")
        known = ingest_landing(spark, f"{run}/landing/*/*", bronze, state).schema
    kept = read_bronze(spark, bronze, known, rescued=True).groupBy("temporada")
    kept = kept.agg(F.count(F.lit(1)).alias("partidos"), F.count(landing.RESCUED).alias("rescatados"))
    season = F.regexp_extract("value", r"(\d+)", 1).alias("temporada")
    aside = read_quarantine(spark, bronze).groupBy(season).agg(F.count(F.lit(1)).alias("apartados"))
    return kept.join(aside, "temporada", "full").select("temporada", "partidos", "rescatados", "apartados")


def q_bronze_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents of the English seasons land cut off and are set aside; mended, they are fed back, once (K1)."""
    run = new_run_dir(spark, "bronze_replay")
    docs = _documents(spark, sf_dir)
    late = F.col("temporada") > FIRST_DROP_LAST_SEASON
    _land(docs.filter(~late), f"{run}/landing/good")
    broken = F.regexp_replace(F.to_json(F.struct("temporada", spec.DATA_FIELD)), r"\]\}$", "")
    writer = docs.filter(late).select(broken.alias("value")).write.option("compression", COMPRESSION)
    writer.option("maxRecordsPerFile", DOCUMENTS_PER_FILE).text(f"{run}/landing/broken")
    bronze, state = f"{run}/bronze", f"{run}/state"
    ingest_landing(spark, f"{run}/landing/*/*", bronze, state)
    for _ in range(2):
        known = replay_quarantine(spark, bronze, state, lambda text: F.concat(text, F.lit("]}"))).schema
    return read_bronze(spark, bronze, known).drop(spec.SOURCE_FILE_COL, spec.LOAD_TIME_COL)


def q_bronze_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two drops, then the stream's state is lost; a third drop goes on with a new state."""
    run = new_run_dir(spark, "bronze_restart")
    docs = _documents(spark, sf_dir)
    season = F.col("temporada")
    drops = [season <= FIRST_DROP_LAST_SEASON, (season > FIRST_DROP_LAST_SEASON) & (season <= 2023), season > 2023]
    bronze = f"{run}/bronze"
    for i, (chosen, state) in enumerate(zip(drops, ("state", "state", "new_state"), strict=True)):
        _land(docs.filter(chosen), f"{run}/landing/drop{i}")
        ingest_landing(spark, f"{run}/landing/*/*.json.lz4", bronze, f"{run}/{state}")
    return read_bronze(spark, bronze).groupBy("temporada").agg(F.count(F.lit(1)).alias("partidos"))


def q_dq_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three drops and refreshes; the rules' state of the whole Silver table from the counts of its batches (Q2)."""
    run = new_run_dir(spark, "dq_history")
    docs = _documents(spark, sf_dir)
    season = F.col("temporada")
    for i, chosen in enumerate((season <= FIRST_DROP_LAST_SEASON, (season > FIRST_DROP_LAST_SEASON) & (season <= 2023), season > 2023)):
        _land(docs.filter(chosen), f"{run}/landing/drop{i}")
        layers.refresh_layers(spark, f"{run}/landing/*/*.json.lz4", f"{run}/tables", skip_gold=True)
    return layers.rule_totals(spark, f"{run}/tables")


TYPED_CHANGES = spec.STATS[0][1]  # a plain statistic of the English layout, number first, then text
TYPED_STAYS = spec.STATS[1][1]


def q_bronze_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two drops in which one statistic goes from number to text, read with the remembered types."""
    run = new_run_dir(spark, "bronze_typed")
    docs, season = _documents(spark, sf_dir), F.col("temporada")
    text = F.transform(spec.DATA_FIELD, lambda m: m.withField(f"`{TYPED_CHANGES}`", F.concat(m[TYPED_CHANGES].cast("string"), F.lit(" (9%)"))))
    files, bronze, state = f"{run}/landing/*/*.json.lz4", f"{run}/bronze", f"{run}/state"
    for drop, part in (("drop1", docs.filter(season <= 2023)), ("drop2", docs.filter(season > 2023).withColumn(spec.DATA_FIELD, text))):
        _land(part, f"{run}/landing/{drop}")
        known = ingest_landing(spark, files, bronze, state).schema
    rows = read_bronze(spark, bronze, known, typed=True)
    return rows.select("url", "temporada", F.col(f"`{TYPED_CHANGES}`").alias("cambia"), F.col(f"`{TYPED_STAYS}`").alias("sigue"))


def q_layer_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing -> Bronze stream -> Silver table -> Gold tables; standings read back."""
    run = new_run_dir(spark, "layers")
    _land(_documents(spark, sf_dir), f"{run}/landing/drop1")
    layers.refresh_layers(spark, f"{run}/landing/*/*.json.lz4", f"{run}/tables")
    return layers.read_layer(spark, f"{run}/tables", layers.STANDINGS)


def q_layer_refresh_recovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two drops; the refresh of the second ends before Gold; a plain refresh without
    new files must bring Gold up to date (K3)."""
    run = new_run_dir(spark, "layers_recovery")
    docs = _documents(spark, sf_dir)
    files, tables = f"{run}/landing/*/*.json.lz4", f"{run}/tables"
    _land(docs.filter(F.col("temporada") <= FIRST_DROP_LAST_SEASON), f"{run}/landing/drop1")
    layers.refresh_layers(spark, files, tables)
    _land(docs.filter(F.col("temporada") > FIRST_DROP_LAST_SEASON), f"{run}/landing/drop2")
    layers.refresh_layers(spark, files, tables, skip_gold=True)
    layers.refresh_layers(spark, files, tables)
    return layers.read_layer(spark, tables, layers.STANDINGS)


# --- Silver steps -----------------------------------------------------------


def q_sanitize_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    mapping = dict(spec.BASE_RENAMES)
    mapping.update({sanitized(es): target for es, _, target in spec.STATS})
    return rename_columns(sanitize_column_names(_raw(spark, sf_dir)), mapping)


def q_unify_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _no_audit(_unified(spark, sf_dir))


def q_parse_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.parse_dates(_unified(spark, sf_dir)).select("url", "temporada", "fecha")


def q_parse_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = silver.parse_score(_unified(spark, sf_dir))
    return out.select("url", "marcador", "goles_local", "goles_visitante", "resultado")


def _split_columns() -> list[str]:
    cols = []
    for c in spec.STATS_WITH_PCT:
        cols += [c, f"{c}_pct"]
    return cols


def q_split_value_pct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.split_value_pct(_unified(spark, sf_dir)).select("url", *_split_columns())


def q_percent_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.split_value_pct(_unified(spark, sf_dir)).select("url", *spec.STATS_PCT_ONLY)


def q_split_some(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Splitting rows that lack half of the listed statistics."""
    lacking = _unified(spark, sf_dir).drop(*spec.STATS_WITH_PCT[::2], spec.STATS_PCT_ONLY[0])
    return silver.split_value_pct(lacking).select("url", *_split_columns()[2::4], *_split_columns()[3::4], spec.STATS_PCT_ONLY[1])


def q_silver_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _no_audit(_silver(spark, sf_dir))


# --- Gold -------------------------------------------------------------------


def q_team_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.team_view(gold.played(_silver(spark, sf_dir)), spec.gold_stat_bases())


def q_standings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _standings(spark, sf_dir)


def q_team_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _performance(spark, sf_dir)


# --- Rules ------------------------------------------------------------------


def q_dq_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.rule_report(_silver(spark, sf_dir), spec.SILVER_RULES)


def q_dq_standings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.rule_report(_standings(spark, sf_dir), spec.STANDINGS_RULES)


def q_dq_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.rule_report(_performance(spark, sf_dir), spec.PERFORMANCE_RULES)


# --- Consumption ------------------------------------------------------------


def q_season_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return consume.season_table(_standings(spark, sf_dir))


def q_all_time_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return consume.all_time_points(_standings(spark, sf_dir))


def q_season_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    return consume.season_record(_standings(spark, sf_dir))


def q_team_evolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return consume.team_evolution(_standings(spark, sf_dir))


def q_home_vs_away(spark: SparkSession, sf_dir: str) -> DataFrame:
    return consume.home_vs_away(_performance(spark, sf_dir))


def q_possession_and_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return consume.possession_and_accuracy(_silver(spark, sf_dir))


def q_shots_on_target_evolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return consume.shots_on_target_evolution(_performance(spark, sf_dir))


def q_away_fouls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return consume.away_fouls(_performance(spark, sf_dir))


def q_fouls_and_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return consume.fouls_and_cards(_silver(spark, sf_dir))


# --- Oracle SQL -------------------------------------------------------------


def _sql_bronze_lineage() -> str:
    season = "CAST(year(o_orderdate) + 25 AS VARCHAR)"
    return (
        f"SELECT {season} AS temporada,"
        f" printf('%s-%06d', {season}, o_orderkey // {MATCHES_PER_DOCUMENT}) AS documento,"
        " count(*) AS partidos, count(*) AS con_hora_de_carga FROM orders GROUP BY 1, 2"
    )


def _sql_bronze_quarantine() -> str:
    return (
        "SELECT CAST(year(o_orderdate) + 25 AS VARCHAR) AS temporada, count(*) AS partidos,"
        " CAST(1 AS BIGINT) AS apartados FROM orders GROUP BY 1"
    )


def _sql_bronze_rescue() -> str:
    return (
        "SELECT CAST(year(o_orderdate) + 25 AS VARCHAR) AS temporada, count(*) AS partidos,"
        " count(*) FILTER (WHERE o_orderkey % 7 = 0) AS rescatados,"
        " count(*) FILTER (WHERE o_orderkey % 10 = 1) + 1 AS apartados FROM orders GROUP BY 1"
    )


def _sql_bronze_restart() -> str:
    return "SELECT CAST(year(o_orderdate) + 25 AS VARCHAR) AS temporada, count(*) AS partidos FROM orders GROUP BY 1"


def _sql_bronze_typed() -> str:
    changes, stays = oracle.q(TYPED_CHANGES), oracle.q(TYPED_STAYS)
    return (
        f"SELECT url, temporada, CAST({changes} AS VARCHAR) || CASE WHEN temporada > 2023 THEN ' (9%)' ELSE '' END AS cambia,"
        f" {stays} AS sigue FROM ({oracle.raw_sql()}) r"
    )


def _sql_sanitize_rename() -> str:
    mapping = dict(spec.BASE_RENAMES)
    mapping.update({es: target for es, _, target in spec.STATS})
    names = ["temporada", *spec.BASE_RENAMES] + spec.landing_stat_names()
    cols = [f"{oracle.q(n)} AS {oracle.q(mapping.get(n, sanitized(n)))}" for n in names]
    return "SELECT " + ", ".join(cols) + f" FROM ({oracle.raw_sql()}) r"


def _sql_unify() -> str:
    return oracle.unified_select(oracle.raw_sql())


def _sql_silver_columns(cols: list[str]) -> str:
    return "SELECT " + ", ".join(oracle.q(c) for c in cols) + f" FROM ({oracle.silver_sql()}) s"


def _sql_parse_dates() -> str:
    return _sql_silver_columns(["url", "temporada", "fecha"])


def _sql_parse_score() -> str:
    return _sql_silver_columns(["url", "marcador", "goles_local", "goles_visitante", "resultado"])


def _sql_split() -> str:
    return _sql_silver_columns(["url", *_split_columns()])


def _sql_split_some() -> str:
    return _sql_silver_columns(["url", *_split_columns()[2::4], *_split_columns()[3::4], spec.STATS_PCT_ONLY[1]])


def _sql_percent_only() -> str:
    return _sql_silver_columns(["url", *spec.STATS_PCT_ONLY])


def _sql_team_view() -> str:
    played = f"SELECT * FROM ({oracle.silver_sql()}) s WHERE resultado IS NOT NULL"
    return oracle.team_view_select(played, spec.gold_stat_bases())


def _sql_season_table() -> str:
    return (
        "SELECT temporada, posicion, equipo, partidos_jugados, victorias, empates, derrotas,"
        " goles_favor, goles_contra, diferencia_goles, puntos"
        f" FROM ({oracle.standings_sql()}) g ORDER BY temporada, posicion, equipo"
    )


def _ranked_sql(src: str, order: str) -> str:
    return f"SELECT CAST(rank() OVER (ORDER BY {order}) AS INTEGER) AS puesto, * FROM ({src}) r"


def _sql_all_time_points() -> str:
    return _ranked_sql(
        "SELECT equipo, CAST(sum(puntos) AS BIGINT) AS puntos_totales,"
        " CAST(sum(diferencia_goles) AS BIGINT) AS diferencia_goles_total,"
        " CAST(sum(partidos_jugados) AS BIGINT) AS partidos_jugados, count(*) AS temporadas"
        f" FROM ({oracle.standings_sql()}) g GROUP BY equipo",
        "puntos_totales DESC, diferencia_goles_total DESC",
    )


def _sql_season_record() -> str:
    return (
        "SELECT temporada, equipo, partidos_jugados, victorias, empates, derrotas"
        f" FROM ({oracle.standings_sql()}) g"
    )


def _sql_team_evolution() -> str:
    w = "OVER (PARTITION BY equipo ORDER BY temporada)"
    return (
        f"SELECT equipo, temporada, puntos, posicion, lag(puntos) {w} AS puntos_anterior,"
        f" puntos - lag(puntos) {w} AS variacion_puntos, lag(posicion) {w} AS posicion_anterior,"
        f" lag(posicion) {w} - posicion AS mejora_posicion FROM ({oracle.standings_sql()}) g"
    )


def _sql_home_vs_away() -> str:
    cols = []
    for role in (spec.SIDE_HOME, spec.SIDE_AWAY):
        for m in consume.HOME_AWAY_MEASURES:
            cols.append(f"max(CASE WHEN rol = '{role}' THEN {m} END) AS {role}_{m}")
    return (
        "SELECT temporada, equipo, " + ", ".join(cols)
        + f" FROM ({oracle.performance_sql()}) p GROUP BY temporada, equipo"
    )


def _sql_possession_and_accuracy() -> str:
    recent = (
        f"SELECT * FROM ({oracle.silver_sql()}) s WHERE resultado IS NOT NULL"
        f" AND temporada >= {spec.PERFORMANCE_START_YEAR}"
    )
    teams = oracle.team_view_select(recent, ["posesion", "disparos_puerta", "tiros_totales"])
    return _ranked_sql(
        "SELECT temporada, equipo, rol, avg(posesion) AS posesion_promedio,"
        " CAST(sum(disparos_puerta) AS DOUBLE) / nullif(sum(tiros_totales), 0) AS precision_tiro"
        f" FROM ({teams}) t GROUP BY temporada, equipo, rol",
        "posesion_promedio DESC NULLS LAST, precision_tiro DESC NULLS LAST",
    )


def _sql_shots_on_target_evolution() -> str:
    w = "OVER (PARTITION BY equipo, rol ORDER BY temporada)"
    return (
        f"SELECT equipo, rol, temporada, disparos_puerta_promedio,"
        f" lag(disparos_puerta_promedio) {w} AS disparos_puerta_anterior,"
        f" disparos_puerta_promedio - lag(disparos_puerta_promedio) {w} AS variacion"
        f" FROM ({oracle.performance_sql()}) p"
    )


def _sql_away_fouls() -> str:
    return _ranked_sql(
        "SELECT temporada, equipo, faltas_promedio, tarjetas_amarillas_promedio,"
        f" tarjetas_rojas_promedio FROM ({oracle.performance_sql()}) p"
        f" WHERE rol = '{spec.SIDE_AWAY}'",
        "faltas_promedio DESC NULLS LAST",
    )


def _sql_fouls_and_cards() -> str:
    played = f"SELECT * FROM ({oracle.silver_sql()}) s WHERE resultado IS NOT NULL"
    teams = oracle.team_view_select(played, ["faltas", "tarjetas_amarillas", "tarjetas_rojas"])
    return _ranked_sql(
        "SELECT temporada, equipo, count(faltas) AS partidos_con_estadisticas,"
        " avg(faltas) AS faltas_por_partido,"
        " avg(tarjetas_amarillas + tarjetas_rojas) AS tarjetas_por_partido"
        f" FROM ({teams}) t GROUP BY temporada, equipo",
        "faltas_por_partido DESC NULLS LAST, tarjetas_por_partido DESC NULLS LAST",
    )


def _sql_silver_matches() -> str:
    return oracle.silver_sql()


QUERIES: dict[str, tuple[QueryFn, Callable[[], str] | None]] = {
    "bronze_explode": (q_bronze_explode, lambda: oracle.raw_sql()),
    "bronze_stream_ingest": (q_bronze_stream_ingest, lambda: oracle.raw_sql(as_text=True)),
    "bronze_lineage": (q_bronze_lineage, _sql_bronze_lineage),
    "bronze_quarantine": (q_bronze_quarantine, _sql_bronze_quarantine),
    "bronze_rescue": (q_bronze_rescue, _sql_bronze_rescue),
    "bronze_replay": (q_bronze_replay, lambda: oracle.raw_sql(as_text=True)),
    "bronze_restart": (q_bronze_restart, _sql_bronze_restart),
    "bronze_typed": (q_bronze_typed, _sql_bronze_typed),
    "layer_refresh": (q_layer_refresh, lambda: oracle.standings_sql()),
    "layer_refresh_recovery": (q_layer_refresh_recovery, lambda: oracle.standings_sql()),
    "sanitize_rename": (q_sanitize_rename, _sql_sanitize_rename),
    "unify_languages": (q_unify_languages, _sql_unify),
    "parse_dates": (q_parse_dates, _sql_parse_dates),
    "parse_score": (q_parse_score, _sql_parse_score),
    "split_value_pct": (q_split_value_pct, _sql_split),
    "split_some": (q_split_some, _sql_split_some),
    "percent_only": (q_percent_only, _sql_percent_only),
    "silver_matches": (q_silver_matches, _sql_silver_matches),
    "team_view": (q_team_view, _sql_team_view),
    "standings": (q_standings, lambda: oracle.standings_sql()),
    "team_performance": (q_team_performance, lambda: oracle.performance_sql()),
    "dq_silver": (
        q_dq_silver,
        lambda: oracle.rule_report_sql(oracle.silver_sql(), spec.SILVER_RULES),
    ),
    "dq_history": (
        q_dq_history,
        lambda: oracle.rule_report_sql(oracle.silver_sql(), spec.SILVER_RULES),
    ),
    "dq_standings": (
        q_dq_standings,
        lambda: oracle.rule_report_sql(oracle.standings_sql(), spec.STANDINGS_RULES),
    ),
    "dq_performance": (
        q_dq_performance,
        lambda: oracle.rule_report_sql(oracle.performance_sql(), spec.PERFORMANCE_RULES),
    ),
    "season_table": (q_season_table, _sql_season_table),
    "all_time_points": (q_all_time_points, _sql_all_time_points),
    "season_record": (q_season_record, _sql_season_record),
    "team_evolution": (q_team_evolution, _sql_team_evolution),
    "home_vs_away": (q_home_vs_away, _sql_home_vs_away),
    "possession_and_accuracy": (q_possession_and_accuracy, _sql_possession_and_accuracy),
    "shots_on_target_evolution": (q_shots_on_target_evolution, _sql_shots_on_target_evolution),
    "away_fouls": (q_away_fouls, _sql_away_fouls),
    "fouls_and_cards": (q_fouls_and_cards, _sql_fouls_and_cards),
}


def queries() -> dict[str, QueryFn]:
    return {name: fn for name, (fn, _) in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql() for name, (_, sql) in QUERIES.items() if sql is not None}
