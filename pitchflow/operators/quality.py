"""Data-quality rules: report, never drop (Q1-Q5).

A rule is a name plus a Spark SQL boolean expression. Every rule is checked
in one pass over the table: one global aggregate whose partial counts are
combined map-side, so the report costs a single scan plus a one-row
exchange at any size. Each rule gets three counts, because a rule on NULL
input is neither passed nor failed:

* ``passed``  - the expression is TRUE,
* ``failed``  - it is FALSE,
* ``unknown`` - it is NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

Rule = tuple[str, str]


def load_rules(entries: list[dict] | list[Rule]) -> dict[str, str]:
    """``[{"name": n, "constraint": c}, ...]`` or ``[(n, c), ...]`` -> ``{n: c}`` (Q1)."""
    out: dict[str, str] = {}
    for e in entries:
        name, constraint = (e["name"], e["constraint"]) if isinstance(e, dict) else e
        out[name] = constraint
    return out


def rule_counts(rules: list[Rule]) -> list[Column]:
    """The row count (``rows``), and per rule ``passed_i`` and ``failed_i``; the rest is unknown."""
    exprs = [F.count(F.lit(1)).alias("rows")]
    for i, (_, constraint) in enumerate(rules):
        cond = F.expr(constraint)
        exprs += [
            F.count_if(cond).alias(f"passed_{i}"),
            F.count_if(~cond).alias(f"failed_{i}"),
        ]
    return exprs


def rule_report(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """One row per rule: ``rule, passed, failed, unknown`` (Q2); rows are not touched."""
    return df.agg(*rule_counts(rules)).select(F.inline(report_rows([name for name, _ in rules])))


def report_rows(names: list[str]) -> Column:
    """Array of ``(rule, passed, failed, unknown)`` from the columns of :func:`rule_counts`."""
    rows = [
        F.struct(
            F.lit(name).alias("rule"),
            F.col(f"passed_{i}").alias("passed"),
            F.col(f"failed_{i}").alias("failed"),
            (F.col("rows") - F.col(f"passed_{i}") - F.col(f"failed_{i}")).alias("unknown"),
        )
        for i, name in enumerate(names)
    ]
    return F.array(*rows)


def observe_rules(df: DataFrame, rules: list[Rule], name: str) -> tuple[DataFrame, Observation]:
    """Attach the rule counts to ``df`` so they are computed by the next action on it.

    Used when a table is written: the write and the rule check share one
    scan. Read the result with :func:`observation_report` after the action.
    """
    obs = Observation(name)
    return df.observe(obs, *rule_counts(rules)), obs


def observation_report(obs: Observation, rules: list[Rule]) -> list[dict]:
    """Observed counts as ``[{"rule", "passed", "failed", "unknown"}, ...]``."""
    return counts_report(obs.get, rules)


def counts_report(got: dict, rules: list[Rule]) -> list[dict]:
    """Named counts (see :func:`rule_counts`) as one dict per rule."""
    return [
        {
            "rule": rule_name,
            "passed": got.get(f"passed_{i}", 0),
            "failed": got.get(f"failed_{i}", 0),
            "unknown": got.get("rows", 0) - got.get(f"passed_{i}", 0) - got.get(f"failed_{i}", 0),
        }
        for i, (rule_name, _) in enumerate(rules)
    ]
