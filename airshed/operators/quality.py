"""Data-quality rules (QT1-QT6) as one pass per table.

All row rules (not_null, accepted_values, accepted_range, expression tests)
become conditional counts, the unique rules grouping sets of the same
aggregate: the table is read once whatever the number of rules, and counts
are combined per key before the shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    kind: str                 # not_null | unique | accepted_values | accepted_range | expression
    column: str
    values: Sequence = field(default_factory=tuple)
    min_value: float | None = None
    max_value: float | None = None
    condition: str | None = None   # expression rule: SQL predicate that marks a failing row

    @property
    def name(self) -> str:
        return f"{self.kind}:{self.column}"


def failing_condition(rule: Rule) -> Column:
    c = F.col(rule.column)
    if rule.kind == "not_null":
        return c.isNull()
    if rule.kind == "accepted_values":
        return c.isNotNull() & ~c.isin(list(rule.values))
    if rule.kind == "accepted_range":
        cond = F.lit(False)
        if rule.min_value is not None:
            cond = cond | (c < rule.min_value)
        if rule.max_value is not None:
            cond = cond | (c > rule.max_value)
        return c.isNotNull() & cond
    if rule.kind == "expression":
        return F.expr(rule.condition)
    raise ValueError(rule.kind)


def aqi_range_rule(column: str, lo: float = 0, hi: float = 500) -> Rule:
    """QT6: generic index range test."""
    return Rule("accepted_range", column, min_value=lo, max_value=hi)


def run_rules(df: DataFrame, rules_list: Sequence[Rule], table: str = "") -> DataFrame:
    """(table, rule, column, failed) for each rule, from one scan of ``df``."""
    keys = list(dict.fromkeys(r.column for r in rules_list if r.kind == "unique"))
    rows = df.select(*(F.col(c).alias(f"_k{i}") for i, c in enumerate(keys)),
                     *(F.coalesce(failing_condition(r), F.lit(False)).cast("long").alias(f"_r{i}")
                       for i, r in enumerate(rules_list) if r.kind != "unique"))
    sums = [F.sum(f"_r{i}").alias(f"_r{i}") for i, r in enumerate(rules_list) if r.kind != "unique"]
    if keys:
        names = [f"_k{i}" for i in range(len(keys))]
        # () holds the row rules' counts, (key) the rows of each key; a key's
        # set leaves only its own bit of the grouping id at 0
        grouped = rows.groupingSets([[], *[[k] for k in names]], *names).agg(
            F.grouping_id().alias("_set"), F.count(F.lit(1)).alias("_n"), *sums)
        full = (1 << len(keys)) - 1
        counts = []
        for i, r in enumerate(rules_list):
            if r.kind == "unique":
                k = keys.index(r.column)
                own = (F.col("_set") == full - (1 << (len(keys) - 1 - k))) & F.col(f"_k{k}").isNotNull() & (F.col("_n") > 1)
                counts.append(F.sum(F.when(own, F.col("_n"))))
            else:
                counts.append(F.sum(F.when(F.col("_set") == full, F.col(f"_r{i}"))))
    else:
        grouped, counts = rows, [F.sum(f"_r{i}") for i in range(len(rules_list))]
    one = grouped.agg(*(F.coalesce(c, F.lit(0)).cast("long").alias(f"f{i}") for i, c in enumerate(counts)))
    out = one.select(F.stack(F.lit(len(rules_list)), *[x for i, r in enumerate(rules_list)
                                                       for x in (F.lit(r.kind), F.lit(r.column), F.col(f"f{i}"))])
                     .alias("rule", "column", "failed"))
    return out.select(F.lit(table).alias("table_name"), "rule", "column", "failed") if table else out


def failing_rows(df: DataFrame, rule: Rule) -> DataFrame:
    """QT5: the rows that break a row rule (unique: rows of duplicated keys)."""
    if rule.kind == "unique":
        dups = (df.groupBy(rule.column).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1)
                  .select(rule.column))
        return df.join(dups, rule.column, "left_semi")
    return df.filter(failing_condition(rule))


def rows_by_rule(df: DataFrame, rules_by_name: Mapping[str, Rule]) -> DataFrame:
    """QT5 for a table's rules together: each failing row once per rule it
    breaks, with the rule's name in ``rule``.

    The rows are scanned once and tagged with all the rules they break; only
    rows that break one are exploded. A unique rule takes one scan more, of its
    column: its keys are counted, with partial counts before the shuffle,
    and the duplicated ones joined to the rows. Null keys are not duplicates.
    """
    rows, broken = df, []
    for i, (name, rule) in enumerate(rules_by_name.items()):
        if rule.kind == "unique":
            key = df.select(F.col(rule.column).alias(f"_key{i}")).where(F.col(f"_key{i}").isNotNull())
            dups = key.groupBy(f"_key{i}").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")
            rows = rows.join(dups, rows[rule.column] == dups[f"_key{i}"], "left")
            failing = F.col(f"_key{i}").isNotNull()
        else:
            failing = F.coalesce(failing_condition(rule), F.lit(False))
        broken.append(F.when(failing, F.lit(name)))
    tags = F.filter(F.array(*broken), lambda t: t.isNotNull())
    # the outer generator: the array's size is not tested by a filter below, which would compute it twice
    return rows.select(*df.columns, F.explode_outer(tags).alias("rule")).where("rule is not null")


def assert_rules(results: DataFrame) -> None:
    """Stop the pipeline when any rule failed (reads the small result)."""
    bad = results.filter(F.col("failed") > 0).collect()  # a row per declared rule
    if bad:
        raise AssertionError("data quality failures: " + ", ".join(
            f"{r['rule']}:{r['column']}={r['failed']}" for r in bad))


def rules_from_tests(tests) -> dict[str, list[Rule]]:
    """Declared (model, column, test, argument) rows -> rules per model."""
    out: dict[str, list[Rule]] = {}
    for model, column, test, arg in tests:
        if test == "accepted_values":
            rule = Rule("accepted_values", column, values=tuple(arg))
        elif test == "accepted_range":
            lo, hi = arg
            rule = Rule("accepted_range", column, min_value=lo, max_value=hi)
        else:
            rule = Rule(test, column)
        out.setdefault(model, []).append(rule)
    return out


def model_tests(models, tests=None) -> DataFrame:
    """Run the declared tests of every model present in ``models`` (one
    pass per model; its unique tests are grouping sets of the same pass) and
    return (table_name, rule, column, failed) rows."""
    from airshed import rules as R

    per_model = rules_from_tests(tests if tests is not None else R.MODEL_TESTS)
    parts = [run_rules(models[name], rs, table=name) for name, rs in per_model.items() if name in models]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
