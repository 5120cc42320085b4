"""Mapping spec: the declarative description that drives every layer.

Everything a layer needs to know about field names, translations, formats,
Gold settings and quality rules lives here as plain Python data, so the
transforms in ``operators`` stay generic ``DataFrame -> DataFrame`` code.
"""

from __future__ import annotations

from dataclasses import dataclass

# ---------------------------------------------------------------------------
# FIXED VALUES. These must equal the source data's conventions for the
# results to be right; they are stated as-is, in their natural order.
# ---------------------------------------------------------------------------

# Name of the array field that holds the matches inside a season document.
DATA_FIELD = "data"

# Landing field -> Silver name for the base (non-statistic) fields.
BASE_RENAMES = {
    "fecha": "fecha_raw",
    "local": "equipo_local",
    "visitante": "equipo_visitante",
    "marcador": "marcador",
    "url": "url",
}

# One row per statistic column: (Spanish landing name, English landing name,
# Silver name). Spanish wins when both are present. Possession has the same
# landing name in both languages.
STATS = [
    ("Tiros totales_local", "Total shots_local", "tiros_totales_local"),
    ("Tiros totales_visitante", "Total shots_visitante", "tiros_totales_visitante"),
    ("Disparos a puerta_local", "Shots on target_local", "disparos_puerta_local"),
    ("Disparos a puerta_visitante", "Shots on target_visitante", "disparos_puerta_visitante"),
    ("Disparos fuera_local", "Shots off target_local", "disparos_fuera_local"),
    ("Disparos fuera_visitante", "Shots off target_visitante", "disparos_fuera_visitante"),
    ("Tiros bloqueados_local", "Blocked shots_local", "tiros_bloqueados_local"),
    ("Tiros bloqueados_visitante", "Blocked shots_visitante", "tiros_bloqueados_visitante"),
    ("Tiros a los postes_local", "Hit woodwork_local", "tiros_postes_local"),
    ("Tiros a los postes_visitante", "Hit woodwork_visitante", "tiros_postes_visitante"),
    ("Tiros en el área_local", "Shots inside box_local", "tiros_area_local"),
    ("Tiros en el área_visitante", "Shots inside box_visitante", "tiros_area_visitante"),
    ("Tiros fuera del área_local", "Shots outside box_local", "tiros_fuera_area_local"),
    ("Tiros fuera del área_visitante", "Shots outside box_visitante", "tiros_fuera_area_visitante"),
    ("Gran probabilidad_local", "Big chances_local", "gran_probabilidad_local"),
    ("Gran probabilidad_visitante", "Big chances_visitante", "gran_probabilidad_visitante"),
    ("Grandes oportunidades perdidas_local", "Big chances missed_local", "grandes_oportunidades_perdidas_local"),
    ("Grandes oportunidades perdidas_visitante", "Big chances missed_visitante", "grandes_oportunidades_perdidas_visitante"),
    ("Pases precisos_local", "Accurate passes_local", "pases_precisos_local"),
    ("Pases precisos_visitante", "Accurate passes_visitante", "pases_precisos_visitante"),
    ("Pases_local", "Passes_local", "pases_local"),
    ("Pases_visitante", "Passes_visitante", "pases_visitante"),
    ("Tiros largos precisos_local", "Accurate long balls_local", "tiros_largos_precisos_local"),
    ("Tiros largos precisos_visitante", "Accurate long balls_visitante", "tiros_largos_precisos_visitante"),
    ("Centros precisos_local", "Accurate crosses_local", "centros_precisos_local"),
    ("Centros precisos_visitante", "Accurate crosses_visitante", "centros_precisos_visitante"),
    ("Mitad propia_local", "Own half_local", "mitad_propia_local"),
    ("Mitad propia_visitante", "Own half_visitante", "mitad_propia_visitante"),
    ("Mitad rival_local", "Opposition half_local", "mitad_rival_local"),
    ("Mitad rival_visitante", "Opposition half_visitante", "mitad_rival_visitante"),
    ("Toques en el área rival_local", "Touches in opposition box_local", "toques_area_rival_local"),
    ("Toques en el área rival_visitante", "Touches in opposition box_visitante", "toques_area_rival_visitante"),
    ("Saques de esquina_local", "Corners_local", "saques_esquina_local"),
    ("Saques de esquina_visitante", "Corners_visitante", "saques_esquina_visitante"),
    ("Lanzamientos_local", "Throws_local", "lanzamientos_local"),
    ("Lanzamientos_visitante", "Throws_visitante", "lanzamientos_visitante"),
    ("Fueras de juego_local", "Offsides_local", "fueras_juego_local"),
    ("Fueras de juego_visitante", "Offsides_visitante", "fueras_juego_visitante"),
    ("Faltas_local", "Fouls committed_local", "faltas_local"),
    ("Faltas_visitante", "Fouls committed_visitante", "faltas_visitante"),
    ("Tarjetas amarillas_local", "Yellow cards_local", "tarjetas_amarillas_local"),
    ("Tarjetas amarillas_visitante", "Yellow cards_visitante", "tarjetas_amarillas_visitante"),
    ("Tarjetas rojas_local", "Red cards_local", "tarjetas_rojas_local"),
    ("Tarjetas rojas_visitante", "Red cards_visitante", "tarjetas_rojas_visitante"),
    ("Entradas_local", "Tackles_local", "entradas_local"),
    ("Entradas_visitante", "Tackles_visitante", "entradas_visitante"),
    ("Intercepciones_local", "Interceptions_local", "intercepciones_local"),
    ("Intercepciones_visitante", "Interceptions_visitante", "intercepciones_visitante"),
    ("Bloqueos_local", "Blocks_local", "bloqueos_local"),
    ("Bloqueos_visitante", "Blocks_visitante", "bloqueos_visitante"),
    ("Despejes_local", "Clearances_local", "despejes_local"),
    ("Despejes_visitante", "Clearances_visitante", "despejes_visitante"),
    ("Paradas del portero_local", "Keeper saves_local", "paradas_portero_local"),
    ("Paradas del portero_visitante", "Keeper saves_visitante", "paradas_portero_visitante"),
    ("Duelos ganados_local", "Duels won_local", "duelos_ganados_local"),
    ("Duelos ganados_visitante", "Duels won_visitante", "duelos_ganados_visitante"),
    ("Duelo terrestre_local", "Ground duels won_local", "duelo_terrestre_local"),
    ("Duelo terrestre_visitante", "Ground duels won_visitante", "duelo_terrestre_visitante"),
    ("Aéreo ganado_local", "Aerial duels won_local", "aereo_ganado_local"),
    ("Aéreo ganado_visitante", "Aerial duels won_visitante", "aereo_ganado_visitante"),
    ("Regates realizados_local", "Successful dribbles_local", "regates_realizados_local"),
    ("Regates realizados_visitante", "Successful dribbles_visitante", "regates_realizados_visitante"),
    ("Posesión_local", "Posesión_local", "posesion_local"),
    ("Posesión_visitante", "Posesión_visitante", "posesion_visitante"),
]

# Silver columns holding "value (pct%)": split into <name> int and <name>_pct double.
STATS_WITH_PCT = [
    "pases_precisos_local",
    "pases_precisos_visitante",
    "tiros_largos_precisos_local",
    "tiros_largos_precisos_visitante",
    "centros_precisos_local",
    "centros_precisos_visitante",
    "duelo_terrestre_local",
    "duelo_terrestre_visitante",
    "aereo_ganado_local",
    "aereo_ganado_visitante",
    "regates_realizados_local",
    "regates_realizados_visitante",
]

# Silver columns holding only a percentage ("45%"): kept as <name> int.
STATS_PCT_ONLY = [
    "posesion_local",
    "posesion_visitante",
]

# Date formats (Spark datetime patterns) tried in the parse cascade.
DATE_FORMAT_NUMERIC = "dd-MM-yyyy"
DATE_FORMAT_TEXT_EN = "MMMM d, yyyy"

# Regular expressions (Java syntax, also valid RE2).
WEEKDAY_PREFIX_RE = r"^[A-Za-z]+,\s*"
LEADING_INT_RE = r"^(\d+)"
BRACKET_PCT_RE = r"\((\d+(?:\.\d+)?)%\)"
FIRST_NUMBER_RE = r"(\d+(?:\.\d+)?)"
SCORE_SEPARATOR_RE = r" - "

# Side suffixes of the statistic columns and the Gold role labels.
SIDE_HOME = "local"
SIDE_AWAY = "visitante"

# Result letters, from the home side's view.
RESULT_HOME_WIN = "L"
RESULT_AWAY_WIN = "V"
RESULT_DRAW = "E"

# Points per win and per draw (a loss gives 0).
POINTS_WIN = 3
POINTS_DRAW = 1

# Gold performance: base statistic, rounding digits of its average.
GOLD_STATS = [
    ("posesion", 1),
    ("tiros_totales", 1),
    ("disparos_puerta", 1),
    ("faltas", 1),
    ("tarjetas_amarillas", 2),
    ("tarjetas_rojas", 2),
    ("saques_esquina", 1),
]

# First season of the performance table (detailed statistics exist from then on).
PERFORMANCE_START_YEAR = 2022

# Data-quality rules: (name, Spark SQL boolean expression).
SILVER_RULES = [
    ("equipo_local no nulo", "equipo_local IS NOT NULL"),
    ("equipo_visitante no nulo", "equipo_visitante IS NOT NULL"),
    ("marcador valido", "marcador IS NOT NULL AND marcador RLIKE '^[0-9]+ - [0-9]+$'"),
    ("goles no negativos", "goles_local >= 0 AND goles_visitante >= 0"),
    ("temporada valida", "temporada BETWEEN 2020 AND 2030"),
    ("posesion valida", "posesion_local IS NULL OR (posesion_local BETWEEN 0 AND 100)"),
]

STANDINGS_RULES = [
    ("equipo no nulo", "equipo IS NOT NULL"),
    ("temporada valida", "temporada BETWEEN 2020 AND 2030"),
    ("puntos no negativos", "puntos >= 0"),
    ("partidos jugados positivo", "partidos_jugados > 0"),
    ("posicion positiva", "posicion >= 1"),
    ("suma partidos cuadra", "victorias + empates + derrotas = partidos_jugados"),
]

PERFORMANCE_RULES = [
    ("equipo no nulo", "equipo IS NOT NULL"),
    ("rol valido", "rol IN ('local', 'visitante')"),
    ("temporada desde 2022", "temporada >= 2022"),
    ("partidos jugados positivo", "partidos_jugados > 0"),
    ("posesion promedio valida", "posesion_promedio IS NULL OR posesion_promedio BETWEEN 0 AND 100"),
]

# ---------------------------------------------------------------------------
# Derived views of the fixed values above.
# ---------------------------------------------------------------------------

# Audit columns Bronze adds and their Silver names.
SOURCE_FILE_COL = "_source_file"
LOAD_TIME_COL = "_load_timestamp"
AUDIT_RENAMES = {SOURCE_FILE_COL: "fuente", LOAD_TIME_COL: "fecha_carga"}


def stats_spanish() -> list[str]:
    """Spanish landing names, in spec order."""
    return [es for es, _, _ in STATS]


def stats_english() -> list[str]:
    """English landing names that differ from the Spanish one, in spec order."""
    return [en for es, en, _ in STATS if en != es]


def silver_stat_names() -> list[str]:
    """The 64 unified statistic names, in spec order."""
    return [t for _, _, t in STATS]


def landing_stat_names() -> list[str]:
    """Every distinct statistic field a landing document may carry."""
    return stats_spanish() + stats_english()


@dataclass(frozen=True)
class SilverColumn:
    name: str
    type: str  # Spark SQL type name


def silver_schema() -> list[SilverColumn]:
    """Declared Silver schema (87 columns), built by rule from the stat table.

    identity and score columns first, then each statistic (a split
    statistic followed by its ``_pct`` twin), then the audit columns.
    """
    cols = [
        SilverColumn("equipo_local", "string"),
        SilverColumn("equipo_visitante", "string"),
        SilverColumn("marcador", "string"),
        SilverColumn("goles_local", "int"),
        SilverColumn("goles_visitante", "int"),
        SilverColumn("resultado", "string"),
        SilverColumn("fecha", "date"),
        SilverColumn("temporada", "int"),
        SilverColumn("url", "string"),
    ]
    pct = set(STATS_WITH_PCT)
    for name in silver_stat_names():
        cols.append(SilverColumn(name, "int"))
        if name in pct:
            cols.append(SilverColumn(f"{name}_pct", "double"))
    cols.append(SilverColumn("fuente", "string"))
    cols.append(SilverColumn("fecha_carga", "timestamp"))
    return cols


def gold_stat_bases() -> list[str]:
    return [c for c, _ in GOLD_STATS]
