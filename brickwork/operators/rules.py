"""Declared data tests as data (Q1-Q10, A10): all rules of a table in one aggregate, or observed while it is written.

A rule names a table, a check, a column and the check's arguments.  ``run`` compiles the rules of a table that look at a
row by itself, at a column or at the number of rows into one aggregate, so a table is scanned once however many
rules it has.  Uniqueness needs a shuffle by its column and a relationship a join with the parent, so each of these
is a job of its own.  Types are read from the schema.

``observed`` attaches the same aggregate to the frame that a sink is about to write, so that the rules cost no scan
at all; the results come from the observation when the write has ended.

``failures`` is the number of rows (or keys, or for types and row counts: 1) that break the rule; 0 passes.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..session import shuffled

#: Checks that are one expression over a table's rows.
AGGREGATES = ("accepted_values", "between", "not_null", "regex", "all_null", "expression", "row_count", "is_date")


@dataclass(frozen=True)
class Rule:
    table: str
    check: str
    column: str = ""
    args: Mapping[str, Any] = field(default_factory=dict)


def _failing(rule: Rule) -> Column:
    """The failures of an aggregate rule; a NULL passes every check but ``not_null``."""
    c, args = F.col(f"`{rule.column}`") if rule.column else None, rule.args
    if rule.check == "accepted_values":
        return F.count_if(c.isNotNull() & ~c.isin(list(args["values"])))
    if rule.check == "between":
        return F.count_if(~c.between(args["least"], args["most"]))
    if rule.check == "not_null":
        return F.count_if(c.isNull())
    if rule.check == "regex":
        return F.count_if(~c.rlike(args["pattern"]))
    if rule.check == "all_null":
        return F.count(c)
    if rule.check == "expression":
        return F.count_if(~F.expr(args["sql"]))
    if rule.check == "row_count":
        return F.when(F.count(F.lit(1)) >= args["least"], 0).otherwise(1).cast("long")
    if rule.check == "is_date":
        return F.count_if(c.isNotNull() & c.cast("string").try_cast("date").isNull())
    raise ValueError(rule.check)


def _aggregates(rules: Sequence[Rule]) -> list[Column]:
    return [F.coalesce(_failing(r), F.lit(0)).cast("long").alias(f"r{i}") for i, r in enumerate(rules)]


def _line(rules: Sequence[Rule], failures: Sequence[Column]) -> Column:
    return F.explode(F.array(*[F.struct(F.lit(r.table).alias("table"), F.lit(r.check).alias("check"), F.lit(r.column).alias("column"), f.alias("failures")) for r, f in zip(rules, failures, strict=True)]))


def _wrong_type(rule: Rule, df: DataFrame) -> int:
    held = {f.name: f.dataType.simpleString().split("(")[0] for f in df.schema.fields}
    return int(held.get(rule.column) not in rule.args["types"])


def run(tables: Mapping[str, DataFrame], rules: Sequence[Rule]) -> DataFrame:
    """``(table, check, column, failures)``, a line a rule.  A rule on a column that its table lacks raises."""
    parts = []
    for name in dict.fromkeys(r.table for r in rules):
        df, mine = tables[name], [r for r in rules if r.table == name]
        whole = [r for r in mine if r.check in AGGREGATES]
        if whole:
            parts.append(df.agg(*_aggregates(whole)).select(_line(whole, [F.col(f"r{i}") for i in range(len(whole))]).alias("l")))
        types = [r for r in mine if r.check == "type"]
        if types:
            wrong = [F.lit(_wrong_type(r, df)).cast("long") for r in types]
            parts.append(df.sparkSession.range(1).select(_line(types, wrong).alias("l")))
        for rule in mine:
            if rule.check == "unique":
                repeated = df.filter(F.col(f"`{rule.column}`").isNotNull()).groupBy(f"`{rule.column}`").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
            elif rule.check == "relationship":
                parent = tables[rule.args["to"]].select(F.col(f"`{rule.args['field']}`").alias("_parent")).distinct()
                child = df.select(F.col(f"`{rule.column}`").alias("_child")).filter("_child IS NOT NULL")
                repeated = child.join(shuffled(parent), F.col("_child") == F.col("_parent"), "left_anti")
            elif rule.check == "fewer_rows_than":
                other = tables[rule.args["than"]].agg(F.count(F.lit(1)).alias("n"))
                counts = df.agg(F.count(F.lit(1)).alias("n")).withColumn("side", F.lit(0)).unionByName(other.withColumn("side", F.lit(1)))
                broken = F.max_by("n", "side") <= F.min_by("n", "side")
                parts.append(counts.agg(broken.cast("long").alias("f")).select(_line([rule], [F.col("f")]).alias("l")))
                continue
            elif rule.check in AGGREGATES or rule.check == "type":
                continue
            else:
                raise ValueError(rule.check)
            parts.append(repeated.agg(F.count(F.lit(1)).alias("f")).select(_line([rule], [F.col("f")]).alias("l")))
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    return out.select("l.*")


class Observed:
    """Results of rules that were watched during a write."""

    def __init__(self, rules: Sequence[Rule], observation: Observation):
        self.rules, self.observation = rules, observation

    def failures(self) -> list[tuple[Rule, int]]:
        """Every rule with its failures; waits for the write."""
        found = self.observation.get
        return [(r, found[f"r{i}"]) for i, r in enumerate(self.rules)]


def observed(df: DataFrame, table: str, rules: Sequence[Rule]) -> tuple[DataFrame, Observed]:
    """``df``, which checks the table's aggregate rules when it is written, and where their results will be."""
    mine = [r for r in rules if r.table == table and r.check in AGGREGATES]
    watch = Observation(table)
    return df.observe(watch, *_aggregates(mine)), Observed(mine, watch)
