"""Layer refresh: landing -> Bronze -> Silver -> Gold (K3).

Plain functions called in layer order; no scheduler. Bronze, Silver and the
sums Gold is made of grow by batches with the same numbers, each a folder that
counts once its write is committed. What is left to do is always the difference
between two layers' committed batches, read from the folders themselves: a
batch is due if the next layer lacks it or has it from before it was last
written. A refresh after a failure, wherever it happened, does what is missing.

* Bronze: incremental streaming ingest; one batch per micro-batch.
* Silver: one narrow stage over each Bronze batch that has no Silver batch yet,
  partitioned by season. ``full`` writes all batches again.
* Sums: each new Silver batch added up by season, team and role: sums and
  counts, read from the new Silver files only.
* Gold: standings and performance, rolled up from the sums of all batches, a few
  rows per batch, season and team. Both tables are rewritten by every refresh,
  so neither can stay behind Silver.

All batches that are due go through a layer in one job, however many they are.

Quality rules: the counts of every Silver batch and rule are a table that grows with
the batches, so that the rules' state of the whole table, or of any update, can be
read without scanning Silver. Gold's counts are observed while it is written.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitchflow import spec
from pitchflow.operators import gold, silver
from pitchflow.operators.quality import load_rules, observation_report, observe_rules, report_rows, rule_counts
from pitchflow.sources.landing import RESCUED, SchemaStore, as_stored, bronze_schema
from pitchflow.sources.tables import (
    BATCH,
    committed_batches,
    merge_batches,
    pending_batches,
    read_batches,
    read_table,
    register_table,
    table_path,
    write_batches,
    write_table,
)
from pitchflow.streaming.bronze import IngestResult, ingest_landing, read_bronze

BRONZE = ("bronze", "bronze_partidos")
SILVER = ("silver", "silver_partidos")
RULES = ("silver", "silver_reglas")
SUMS = ("gold", "gold_sumas_equipo")
STANDINGS = ("gold", "gold_tabla_posiciones")
PERFORMANCE = ("gold", "gold_rendimiento_equipo")

# Files per micro-batch of the ingest: a backfill commits in bounded steps,
# so a failure repeats one step, not the whole history.
MAX_FILES_PER_TRIGGER = 10_000

COMMENTS = {
    BRONZE: "Match rows as landed: original field names, every value as text, with source file and load time.",
    SILVER: "Match statistics: two languages unified, dates and scores parsed, value/pct split.",
    STANDINGS: "Standings per season and team, played matches only.",
    PERFORMANCE: "Average performance per season, team and role, from the start year on.",
}


@dataclass
class LayerRun:
    root: str
    bronze: IngestResult
    rules: dict[str, list[dict]] = field(default_factory=dict)
    silver_batches: list[int] = field(default_factory=list)

    def path(self, layer_table: tuple[str, str]) -> str:
        return table_path(self.root, *layer_table)


def _state(root: str) -> str:
    return f"{root}/_state/{BRONZE[1]}"


def silver_table_schema() -> T.StructType:
    kinds = {"string": T.StringType(), "int": T.IntegerType(), "double": T.DoubleType(), "date": T.DateType(), "timestamp": T.TimestampType()}
    return T.StructType([T.StructField(c.name, kinds[c.type], True) for c in spec.silver_schema()])


def read_layer(spark: SparkSession, root: str, layer_table: tuple[str, str]) -> DataFrame:
    """The rows of a layer table, with its declared columns also when it has no rows."""
    root = root.rstrip("/")
    path = table_path(root, *layer_table)
    if layer_table == BRONZE:
        return read_bronze(spark, path, SchemaStore(spark, f"{_state(root)}/schema").load()[0] or T.StructType([]))
    matches = spark.createDataFrame([], silver_table_schema())
    if layer_table == SILVER:
        return read_batches(spark, path, matches.schema)
    sums = gold.team_sums(matches)
    if layer_table == SUMS:
        return read_batches(spark, path, sums.schema)
    schema = (gold.standings_of(sums) if layer_table == STANDINGS else gold.performance_of(sums)).schema
    return read_table(spark, root, *layer_table, schema)


RULE_COUNTS = T.StructType(
    [T.StructField("rule", T.StringType()), *[T.StructField(c, T.LongType()) for c in ("passed", "failed", "unknown")]]
)


def rule_history(spark: SparkSession, root: str, batches: list[int] | None = None) -> DataFrame:
    """(lote, rule, passed, failed, unknown) of every Silver batch, or of some."""
    return read_batches(spark, table_path(root.rstrip("/"), *RULES), RULE_COUNTS, batches, numbered=True)


def rule_totals(spark: SparkSession, root: str, batches: list[int] | None = None) -> DataFrame:
    """(rule, passed, failed, unknown) of the whole Silver table, added up from its batches' counts, or of some batches."""
    counts = [F.sum(c).alias(c) for c in ("passed", "failed", "unknown")]
    return rule_history(spark, root, batches).groupBy("rule").agg(*counts)


def refresh_silver(
    spark: SparkSession, root: str, *, full: bool = False, typed: bool = False, register: bool = False
) -> tuple[list[dict], list[int]]:
    """Write the Silver batches that are missing, or all of them, in one job, and their rule counts in another.

    Returns the rule report of the rows written and the batches' numbers.
    """
    source, target = table_path(root, *BRONZE), table_path(root, *SILVER)
    pending = list(committed_batches(spark, source)) if full else pending_batches(spark, source, target)
    known, _ = SchemaStore(spark, f"{_state(root)}/schema").load()
    if pending:
        bronze = read_bronze(spark, source, known, pending, typed, numbered=True)
        write_batches(silver.silver_matches(bronze, keep=(BATCH,)), target, pending, ["temporada"])
    rules = load_rules(spec.SILVER_RULES)
    history = table_path(root, *RULES)
    uncounted = pending_batches(spark, target, history)
    if uncounted:
        rows = read_batches(spark, target, silver_table_schema(), uncounted, numbered=True)
        counts = rows.groupBy(BATCH).agg(*rule_counts(list(rules.items())))
        write_batches(counts.select(BATCH, F.inline(report_rows(list(rules)))), history, uncounted)
    if register:
        _register_batches(spark, root, SILVER, silver_table_schema(), "silver", ["temporada"])
    # a batch without rows has no counts
    totals = {r["rule"]: r.asDict() for r in rule_totals(spark, root, pending).collect()} if pending else {}
    return [totals.get(name, {"rule": name, "passed": 0, "failed": 0, "unknown": 0}) for name in rules], pending


def refresh_sums(spark: SparkSession, root: str) -> None:
    """Add up the Silver batches that have no sums yet, or were written again since, in one job."""
    source, target = table_path(root, *SILVER), table_path(root, *SUMS)
    pending = pending_batches(spark, source, target)
    if pending:
        rows = read_batches(spark, source, silver_table_schema(), pending, numbered=True)
        write_batches(gold.team_sums(rows, (BATCH,)), target, pending)


def refresh_gold(spark: SparkSession, root: str, register: bool = False) -> dict[str, list[dict]]:
    """Rewrite both Gold tables from the sums of all batches."""
    sums = read_layer(spark, root, SUMS)
    out = {}
    for table, df, entries in (
        (STANDINGS, gold.standings_of(sums), spec.STANDINGS_RULES),
        (PERFORMANCE, gold.performance_of(sums), spec.PERFORMANCE_RULES),
    ):
        rules = list(load_rules(entries).items())
        observed, obs = observe_rules(df, rules, f"dq_{table[1]}")
        write_table(
            observed, root, *table, partition_by=["temporada"],
            comment=COMMENTS[table], properties={"quality": "gold"}, register=register,
        )
        out[table[1]] = observation_report(obs, rules)
    return out


def merge_layers(spark: SparkSession, root: str, **limits: int) -> dict[str, int]:
    """Merge the old batch folders of every layer that grows by batches; folders written by table.

    Which batches are due in the next layer stays as it is."""
    known, _ = SchemaStore(spark, f"{_state(root)}/schema").load()
    matches = spark.createDataFrame([], silver_table_schema())
    tables = (
        (BRONZE, T.StructType([*bronze_schema(as_stored(known or T.StructType([]))).fields, T.StructField(RESCUED, T.StringType())]), []),
        (SILVER, matches.schema, ["temporada"]),
        (RULES, RULE_COUNTS, []),
        (SUMS, gold.team_sums(matches).schema, []),
    )
    return {table[1]: merge_batches(spark, table_path(root, *table), schema, by, **limits) for table, schema, by in tables}


def _register_batches(spark, root, table, schema: T.StructType, quality: str, partition_by: list[str]) -> None:
    stated = T.StructType([*schema.fields, T.StructField(BATCH, T.IntegerType())])
    register_table(
        spark, root, *table, comment=COMMENTS[table], properties={"quality": quality},
        schema=stated, partition_by=[BATCH, *partition_by],
    )


def refresh_layers(
    spark: SparkSession,
    landing: str,
    root: str,
    *,
    multi_line: bool = False,
    infer_types: bool = False,
    register: bool = False,
    full_silver: bool = False,
    skip_gold: bool = False,
) -> LayerRun:
    """Ingest new landing files and bring every layer up to date.

    ``infer_types`` reads Bronze with the remembered types; ``full_silver`` writes all Silver
    batches again; both mix freely with plain refreshes. ``skip_gold`` stops after Silver.
    """
    root = root.rstrip("/")
    ingest = ingest_landing(
        spark, landing, table_path(root, *BRONZE), _state(root),
        multi_line=multi_line, max_files_per_trigger=MAX_FILES_PER_TRIGGER,
    )
    if register:
        _register_batches(spark, root, BRONZE, bronze_schema(as_stored(ingest.schema)), "bronze", [])
    run = LayerRun(root=root, bronze=ingest)
    run.rules[SILVER[1]], run.silver_batches = refresh_silver(
        spark, root, full=full_silver, typed=infer_types, register=register
    )
    if not skip_gold:
        refresh_sums(spark, root)
        run.rules.update(refresh_gold(spark, root, register))
    if any(merge_layers(spark, root).values()) and register:
        _register_batches(spark, root, BRONZE, bronze_schema(as_stored(ingest.schema)), "bronze", [])
        _register_batches(spark, root, SILVER, silver_table_schema(), "silver", ["temporada"])
    return run
