"""Independent SQL statements of every registered query, for DuckDB.

The SQL re-derives the synthetic matches from ``orders`` and applies the
cleaning, aggregation and rule semantics with DuckDB's own functions
(``try_strptime``, ``string_split``, RE2 regexes, window functions). It shares
only the fixed values of :mod:`pitchflow.spec` with the Spark code.

DuckDB differences handled here:

* text to int goes by a digit rule of its own, without a double in between;
* ``sum`` of integers is HUGEINT: cast to BIGINT / INTEGER like Spark's types;
* ``round`` on a double: Spark rounds the shortest decimal form half-up, so
  the oracle rounds ``CAST(CAST(x AS VARCHAR) AS DECIMAL)``;
* ``RLIKE`` becomes ``regexp_matches`` (both are unanchored searches).
"""

from __future__ import annotations

from pitchflow import spec
from pitchflow.sources import fixture

# Spark datetime patterns of the spec, as strptime/strftime patterns.
_STRPTIME = {spec.DATE_FORMAT_NUMERIC: "%d-%m-%Y", spec.DATE_FORMAT_TEXT_EN: "%B %d, %Y"}


def q(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def to_int(x: str) -> str:
    """Digits with an optional sign and decimal tail, cut at the point."""
    text = f"trim(CAST({x} AS VARCHAR))"
    return (
        f"CASE WHEN regexp_full_match({text}, '[+-]?[0-9]+([.][0-9]*)?')"
        f" THEN TRY_CAST(split_part({text}, '.', 1) AS INTEGER) END"
    )


def spark_round(x: str, digits: int) -> str:
    return f"CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38, 20)), {digits}) AS DOUBLE)"


# ---------------------------------------------------------------------------
# Raw matches (landing layout) from orders.
# ---------------------------------------------------------------------------


def _stat_value(target: str, j: int) -> str:
    k = "o_orderkey"
    if target in spec.STATS_WITH_PCT:
        return (
            f"CAST(100 + ({k} + {j}) % 300 AS VARCHAR) || ' (' || CAST(60 + {k} % 40 AS VARCHAR)"
            f" || CASE WHEN {k} % 4 = 0 THEN '.5' ELSE '' END || '%)'"
        )
    if target in spec.STATS_PCT_ONLY:
        return (
            f"CAST(35 + {k} % 30 AS VARCHAR) || CASE WHEN {k} % 7 = 0 THEN '.5' ELSE '' END || '%'"
        )
    return f"CAST(({k} + {j}) % 20 AS BIGINT)"


def raw_select(with_key: bool = False) -> str:
    """SELECT producing one raw match per order (the fixture)."""
    k, c = "o_orderkey", "o_custkey"
    season = f"CAST(year(o_orderdate) + {fixture.SEASON_SHIFT_YEARS} AS BIGINT)"
    day = f"CAST(CAST(o_orderdate AS DATE) + INTERVAL {fixture.SEASON_SHIFT_YEARS} YEAR AS DATE)"
    t = fixture.TEAMS
    cols = [
        f"{season} AS temporada",
        f"CASE {k} % 3 WHEN 0 THEN strftime({day}, '%d-%m-%Y')"
        f" WHEN 1 THEN strftime({day}, '%A, %B %-d, %Y')"
        f" ELSE strftime({day}, '%A, %B %-d') END AS fecha",
        f"'team_' || lpad(CAST({c} % {t} AS VARCHAR), 2, '0') AS local",
        f"'team_' || lpad(CAST(({c} % {t} + 1 + {k} % 17) % {t} AS VARCHAR), 2, '0') AS visitante",
        f"CASE WHEN {k} % 23 = 0 THEN 'Sin jugar' WHEN {k} % 29 = 0 THEN '2d - 1'"
        f" WHEN {k} % 31 = 0 THEN '1e3 - 7f' ELSE CAST((7 * {k} + {c}) % 5 AS VARCHAR)"
        f" || ' - ' || CAST((3 * {k} + 11 * {c}) % 4 AS VARCHAR) END AS marcador",
        f"'match/' || CAST({k} AS VARCHAR) AS url",
    ]
    spanish = f"{season} = {fixture.SPANISH_SEASON}"
    english = f"({season} >= {fixture.ENGLISH_FROM} AND {k} % 5 <> 0)"
    es_cols, en_cols = [], []
    for j, (es, en, target) in enumerate(spec.STATS):
        v = _stat_value(target, j)
        if es == en:
            es_cols.append(f"CASE WHEN {spanish} OR {english} THEN {v} END AS {q(es)}")
        else:
            es_cols.append(f"CASE WHEN {spanish} THEN {v} END AS {q(es)}")
            en_cols.append(f"CASE WHEN {english} THEN {v} END AS {q(en)}")
    key = [k] if with_key else []
    return "SELECT " + ",\n  ".join(key + cols + es_cols + en_cols) + "\nFROM orders"


def raw_sql(as_text: bool = False) -> str:
    """Raw matches; with ``as_text`` every value is a string (string-safe Bronze)."""
    if not as_text:
        return raw_select()
    names = ["temporada", *spec.BASE_RENAMES] + spec.landing_stat_names()
    return "SELECT " + ", ".join(f"CAST({q(n)} AS VARCHAR) AS {q(n)}" for n in names) + (
        f"\nFROM ({raw_select()}) r"
    )


# ---------------------------------------------------------------------------
# Silver steps.
# ---------------------------------------------------------------------------


def unified_select(src: str) -> str:
    """Base renames + unified statistics (still in landing types)."""
    cols = [f"TRY_CAST(temporada AS INTEGER) AS temporada"]
    cols += [f"{q(landing)} AS {q(silver)}" for landing, silver in spec.BASE_RENAMES.items()]
    for es, en, silver in spec.STATS:
        expr = q(es) if es == en else f"coalesce({q(es)}, {q(en)})"
        cols.append(f"{expr} AS {q(silver)}")
    return "SELECT " + ",\n  ".join(cols) + f"\nFROM ({src}) raw"


def _date_expr() -> str:
    strip = f"regexp_replace(fecha_raw, {lit(spec.WEEKDAY_PREFIX_RE)}, '')"
    num = _STRPTIME[spec.DATE_FORMAT_NUMERIC]
    txt = _STRPTIME[spec.DATE_FORMAT_TEXT_EN]
    return (
        f"coalesce(CAST(try_strptime(fecha_raw, '{num}') AS DATE),"
        f" CAST(try_strptime({strip}, '{txt}') AS DATE),"
        f" CAST(try_strptime({strip} || ', ' || CAST(temporada AS VARCHAR), '{txt}') AS DATE))"
    )


def silver_select(src: str, audit: bool = False) -> str:
    """The full Silver table in declared order (``audit`` keeps fuente/fecha_carga as NULL)."""
    parts = "string_split(marcador, ' - ')"
    stage = (
        f"SELECT *, {_date_expr()} AS fecha,"
        f" {to_int(parts + '[1]')} AS goles_local, {to_int(parts + '[2]')} AS goles_visitante"
        f"\nFROM ({unified_select(src)}) u"
    )
    result = (
        f"CASE WHEN goles_local > goles_visitante THEN '{spec.RESULT_HOME_WIN}'"
        f" WHEN goles_local < goles_visitante THEN '{spec.RESULT_AWAY_WIN}'"
        f" WHEN goles_local = goles_visitante THEN '{spec.RESULT_DRAW}' END"
    )
    with_pct = set(spec.STATS_WITH_PCT)
    pct_only = set(spec.STATS_PCT_ONLY)
    cols = []
    for column in spec.silver_schema():
        n = column.name
        if n == "resultado":
            cols.append(f"{result} AS resultado")
        elif n in ("fuente", "fecha_carga"):
            if audit:
                kind = "VARCHAR" if n == "fuente" else "TIMESTAMP"
                cols.append(f"CAST(NULL AS {kind}) AS {n}")
        elif n.endswith("_pct") and n[: -len("_pct")] in with_pct:
            base = n[: -len("_pct")]
            cols.append(
                f"TRY_CAST(regexp_extract(CAST({q(base)} AS VARCHAR), {lit(spec.BRACKET_PCT_RE)}, 1)"
                f" AS DOUBLE) AS {q(n)}"
            )
        elif n in with_pct:
            cols.append(
                f"{to_int(f'regexp_extract(CAST({q(n)} AS VARCHAR), {lit(spec.LEADING_INT_RE)}, 1)')}"
                f" AS {q(n)}"
            )
        elif n in pct_only:
            cols.append(
                f"{to_int(f'regexp_extract(CAST({q(n)} AS VARCHAR), {lit(spec.FIRST_NUMBER_RE)}, 1)')}"
                f" AS {q(n)}"
            )
        elif column.type == "int" and n in set(spec.silver_stat_names()):
            cols.append(f"{to_int(q(n))} AS {q(n)}")
        else:
            cols.append(q(n))
    return "SELECT " + ",\n  ".join(cols) + f"\nFROM ({stage}) s"


def silver_sql() -> str:
    return silver_select(raw_sql())


# ---------------------------------------------------------------------------
# Gold.
# ---------------------------------------------------------------------------


def team_view_select(src: str, stats: list[str]) -> str:
    def side(own: str, other: str, win: str, loss: str) -> str:
        cols = [
            "temporada",
            f"equipo_{own} AS equipo",
            f"'{own}' AS rol",
            f"goles_{own} AS goles_favor",
            f"goles_{other} AS goles_contra",
            f"CASE WHEN resultado = '{win}' THEN 1 ELSE 0 END AS es_victoria",
            f"CASE WHEN resultado = '{spec.RESULT_DRAW}' THEN 1 ELSE 0 END AS es_empate",
            f"CASE WHEN resultado = '{loss}' THEN 1 ELSE 0 END AS es_derrota",
        ] + [f"{s}_{own} AS {s}" for s in stats]
        return "SELECT " + ", ".join(cols) + f" FROM ({src}) m"

    home = side(spec.SIDE_HOME, spec.SIDE_AWAY, spec.RESULT_HOME_WIN, spec.RESULT_AWAY_WIN)
    away = side(spec.SIDE_AWAY, spec.SIDE_HOME, spec.RESULT_AWAY_WIN, spec.RESULT_HOME_WIN)
    return f"{home}\nUNION ALL\n{away}"


def _played(src: str) -> str:
    return f"SELECT * FROM ({src}) x WHERE resultado IS NOT NULL"


def _record_sql() -> list[str]:
    return [
        "count(*) AS partidos_jugados",
        "CAST(sum(es_victoria) AS INTEGER) AS victorias",
        "CAST(sum(es_empate) AS INTEGER) AS empates",
        "CAST(sum(es_derrota) AS INTEGER) AS derrotas",
        "CAST(sum(goles_favor) AS BIGINT) AS goles_favor",
        "CAST(sum(goles_contra) AS BIGINT) AS goles_contra",
    ]


def _points_sql() -> str:
    return (
        f"CAST(sum(es_victoria) * {spec.POINTS_WIN} + sum(es_empate) * {spec.POINTS_DRAW}"
        " AS INTEGER) AS puntos"
    )


def standings_sql(silver: str | None = None) -> str:
    silver = silver or silver_sql()
    teams = team_view_select(_played(silver), [])
    agg = (
        "SELECT temporada, equipo, " + ", ".join(_record_sql())
        + ", CAST(sum(goles_favor) - sum(goles_contra) AS BIGINT) AS diferencia_goles, "
        + _points_sql() + f"\nFROM ({teams}) t GROUP BY temporada, equipo"
    )
    return (
        "SELECT *, CAST(rank() OVER (PARTITION BY temporada ORDER BY puntos DESC,"
        f" diferencia_goles DESC, goles_favor DESC) AS INTEGER) AS posicion\nFROM ({agg}) a"
    )


def performance_sql(silver: str | None = None, start_year: int = spec.PERFORMANCE_START_YEAR) -> str:
    silver = silver or silver_sql()
    recent = f"SELECT * FROM ({_played(silver)}) p WHERE temporada >= {start_year}"
    teams = team_view_select(recent, spec.gold_stat_bases())
    avgs = [f"{spark_round(f'avg({s})', d)} AS {s}_promedio" for s, d in spec.GOLD_STATS]
    return (
        "SELECT temporada, equipo, rol, " + ", ".join(_record_sql() + [_points_sql()] + avgs)
        + f"\nFROM ({teams}) t GROUP BY temporada, equipo, rol"
    )


# ---------------------------------------------------------------------------
# Rules.
# ---------------------------------------------------------------------------


def _duckdb_rule(constraint: str) -> str:
    """Rule text in DuckDB syntax (only RLIKE differs)."""
    import re

    return re.sub(r"(\w+) RLIKE ('(?:[^']|'')*')", r"regexp_matches(\1, \2)", constraint)


def rule_report_sql(src: str, rules: list[tuple[str, str]]) -> str:
    parts = []
    for name, constraint in rules:
        c = _duckdb_rule(constraint)
        parts.append(
            f"SELECT {lit(name)} AS rule,"
            f" count(*) FILTER (WHERE ({c}) IS TRUE) AS passed,"
            f" count(*) FILTER (WHERE ({c}) IS FALSE) AS failed,"
            f" count(*) FILTER (WHERE ({c}) IS NULL) AS unknown"
            f" FROM ({src}) t"
        )
    return "\nUNION ALL\n".join(parts)
