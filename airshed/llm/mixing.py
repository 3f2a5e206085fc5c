"""Mixing sources to target weights by iterative proportional fitting.

The tokens of the documents are counted by cell (source, language, topic).
Raking scales the cells until their marginals are the targets in each of
the three; a cell's ratio of wanted to present tokens is the probability
with which its documents are kept. No cell can give more than it has, so
the bound is part of the raking: every round scales the cells to each
dimension's targets and cuts them at their tokens (cyclic projections, which
end in a point that meets both if there is one). This is done for a row of
rates from ``RATE`` down; the largest one at which the marginals are met to
within ``WITHIN`` counts. Targets that contradict each other at every rate
are met as nearly as can be, and ``mix_plan`` says how far they are missed.
A document's draw is a hash of its id, so the same corpus always gives the
same sample.

Only values that a target names have cells of their own, all others share
one: the table of cells is bounded by the targets, not by the data, and the
fitting on it takes no distributed step. Counting is a partial aggregation,
so a source with a third of all rows costs one row a task.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Default targets by dimension; each dimension's shares add up to 1.
TARGETS: dict[str, dict[str, float]] = {
    "source": {f"src{i}": 0.05 for i in range(20)},
    "lang": {"en": 0.52, "de": 0.18, "fr": 0.18, "es": 0.12},
    "topic": {"prose": 0.80, "table": 0.06, "symbols": 0.06, "capitals": 0.04, "contact": 0.04},
}
RATE = 0.8                     # largest part of the tokens that is drawn
STEPS = 20                     # rates tried: RATE * (1 - i / STEPS)
ROUNDS = 100                   # of the bounded raking
WITHIN = 0.001                 # of a target share counts as met
OTHER = "(other)"
WORD = r"[^\x20\x09-\x0D]+"


def with_topic(docs: DataFrame) -> DataFrame:
    """Adds ``topic`` (by the marks of a text's form) and ``n_tokens`` (its words).
    Null or empty text: topic 'prose', no tokens."""
    text = F.coalesce(F.col("text"), F.lit(""))
    topic = (
        F.when(text.contains(" | "), "table")
        .when(text.contains("%%%") | text.contains("###"), "symbols")
        .when(text.rlike("[A-Z]") & ~text.rlike("[a-z]"), "capitals")
        .when(text.contains("@"), "contact")
        .otherwise("prose")
    )
    return docs.withColumn("topic", topic).withColumn("n_tokens", F.regexp_count(text, F.lit(WORD)).cast("long"))


def goals_of(cells: pd.DataFrame, targets: dict[str, dict[str, float]]) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each dimension, the value's number of each cell and the values'
    wanted tokens, if all tokens were drawn."""
    tokens = cells["tokens"].to_numpy(dtype=float)
    goals = []
    for dim, wanted in targets.items():
        value, code = np.unique(cells[dim].to_numpy(dtype=str), return_inverse=True)
        present = np.bincount(code, weights=tokens)
        named = np.array([wanted.get(v, 0.0) if p > 0 else 0.0 for v, p in zip(value, present)])
        free = present[named == 0].sum()
        goals.append((code, np.where(named > 0, named / max(named.sum(), 1e-300) * (tokens.sum() - free), present)))
    return goals


def mix_plan(cells: pd.DataFrame, targets: dict[str, dict[str, float]], rate: float = RATE, steps: int = STEPS,
             rounds: int = ROUNDS, within: float = WITHIN) -> tuple[np.ndarray, float, float]:
    """Probability of each cell, the rate they were raked to, and the largest
    distance of a marginal share from its target (more than ``within`` only
    if no rate tried meets the targets; then the nearest one counts)."""
    tokens = cells["tokens"].to_numpy(dtype=float)
    total = tokens.sum()
    if not total:
        return np.full(len(tokens), float(rate)), rate, 0.0
    held = tokens > 0
    goals = goals_of(cells, targets)
    rates = rate * (1 - np.arange(steps) / steps)
    weight = np.repeat(tokens[None, held], steps, axis=0)
    ones = [np.eye(len(goal))[code[held]] for code, goal in goals]       # cells by values
    for _ in range(rounds):
        for (code, goal), one in zip(goals, ones):
            now = (weight @ one)[:, code[held]]
            weight = weight * (rates[:, None] * goal[code[held]]) / np.maximum(now, 1e-300)
        weight = np.minimum(weight, tokens[held])
    missed = np.max([np.abs((weight @ one)[:, code[held]] / weight.sum(axis=1, keepdims=True) - goal[code[held]] / total).max(axis=1)
                     for (code, goal), one in zip(goals, ones)], axis=0)
    met = np.flatnonzero(missed <= within)
    best = int(met[0]) if len(met) else int(missed.argmin())
    chance = np.full(len(tokens), rates[best])
    chance[held] = np.round(weight[best] / tokens[held], 9)
    return chance, float(rates[best]), float(missed[best])


def rake(cells: pd.DataFrame, targets: dict[str, dict[str, float]], rounds: int = 20) -> np.ndarray:
    """Fitted tokens of each cell (columns of the dimensions and ``tokens``).

    Values without a target, and targets whose value has no tokens, keep
    their present share; the other targets are scaled to what is left."""
    weight = cells["tokens"].to_numpy(dtype=float).copy()
    if not weight.sum():
        return weight
    for _ in range(rounds):
        for code, goal in goals_of(cells, targets):
            now = np.bincount(code, weights=weight)
            weight *= np.where(now > 0, goal / np.maximum(now, 1e-300), 0.0)[code]
    return weight


def calibrate(tokens: np.ndarray, wanted: np.ndarray, rate: float = RATE, keep_targets: bool = False) -> np.ndarray:
    """Probabilities min(1, scale * wanted / tokens), the scale such that the
    expected tokens are ``rate`` of all. Cells cut at 1 leave their missing
    tokens to the others, which moves the marginals; with ``keep_targets`` the
    scale is the largest, up to ``rate``, at which no cell is cut."""
    tokens = np.asarray(tokens, dtype=float)
    ratio = np.divide(wanted, tokens, out=np.zeros_like(tokens), where=tokens > 0)
    if keep_targets and ratio.any():
        scale = min(rate * tokens.sum() / float((tokens * ratio).sum()), 1 / ratio.max())
        # no rounding: it would move the marginals of sparse cells
        return np.where(tokens > 0, scale * ratio, rate)
    order = np.argsort(-ratio, kind="stable")
    budget = rate * tokens.sum()
    full, rest = 0.0, float((tokens * ratio).sum())
    scale = 0.0
    for i in order:
        if rest <= 0:
            break
        scale = (budget - full) / rest
        if scale * ratio[i] <= 1:
            break
        full += tokens[i]
        rest -= tokens[i] * ratio[i]
    return np.where(tokens > 0, np.round(np.minimum(1.0, scale * ratio), 6), round(rate, 6))


def marginals(cells: pd.DataFrame, targets: dict[str, dict[str, float]]) -> pd.DataFrame:
    """dim, value, target, present, achieved: shares of the tokens in ``cells``
    (the dimensions, ``tokens``, ``probability``) before and after the draw,
    in expectation."""
    after = cells["tokens"] * cells["probability"]
    out = [(dim, v, w, cells["tokens"][cells[dim] == v].sum() / max(cells["tokens"].sum(), 1e-300),
            after[cells[dim] == v].sum() / max(after.sum(), 1e-300)) for dim, wanted in targets.items() for v, w in wanted.items()]
    return pd.DataFrame(out, columns=["dim", "value", "target", "present", "achieved"])


def mix(docs: DataFrame, targets: dict[str, dict[str, float]] = TARGETS, rate: float = RATE, keep_targets: bool = True) -> DataFrame:
    """Every row with probability and kept. ``rate`` is the most that is
    drawn; without ``keep_targets`` it is drawn whatever the marginals become.

    ``docs`` has doc_id and the dimensions that ``targets`` names, and
    n_tokens. A null in a dimension counts as a value without a target. A
    null doc_id is never kept. Repeated rows draw alike. Documents without
    tokens in a cell without tokens are kept with the rate used. Texts of any
    length count whole. Empty table: empty. Extra columns are passed on.
    """
    dims = list(targets)
    named = {d: F.when(F.col(d).isin(list(targets[d])), F.col(d)).otherwise(F.lit(OTHER)) for d in dims}
    cells = (
        docs.select(*(named[d].alias(d) for d in dims), "n_tokens").groupBy(*dims)
        .agg(F.sum("n_tokens").alias("tokens")).toPandas().sort_values(dims, kind="stable", ignore_index=True)
    )
    if keep_targets:
        cells["probability"], _, _ = mix_plan(cells, targets, rate)
    else:
        cells["probability"] = calibrate(cells["tokens"].to_numpy(dtype=float), rake(cells, targets), rate)
    spark = docs.sparkSession
    columns = [f"cell_{d}" for d in dims]
    schema = ", ".join(f"{c} string" for c in columns) + ", probability double"
    rows = [tuple(map(str, r[:-1])) + (float(r[-1]),) for r in cells[[*dims, "probability"]].itertuples(index=False)]
    table = spark.createDataFrame(rows, schema)
    draw = F.conv(F.substring(F.md5(F.col("doc_id").cast("string").cast("binary")), 1, 8), 16, 10).cast("double") / 2.0**32
    out = docs.withColumns({f"cell_{d}": named[d] for d in dims})
    return out.join(F.broadcast(table), columns, "left").withColumn(
        "kept", F.coalesce(draw < F.col("probability"), F.lit(False))).select(*docs.columns, "probability", "kept")


def oracle_sql(targets: dict[str, dict[str, float]] = TARGETS, rate: float = RATE) -> str:
    """The same computation as DuckDB SQL over ``documents``."""
    dims = list(targets)
    case = {d: f"case when {d} in ({', '.join(repr(v) for v in targets[d])}) then {d} else '{OTHER}' end" for d in dims}
    goal = {d: f"(case cell_{d} " + " ".join(f"when '{v}' then {w!r}" for v, w in targets[d].items()) + " else 0.0 end)" for d in dims}
    keys = ", ".join(f"cell_{d}" for d in dims)
    parts = ", ".join(f"sum(tokens) over (partition by cell_{d}) as p_{d}, {goal[d]} as n_{d}" for d in dims)
    share = ", ".join(f"(select sum(n) from (select distinct cell_{d}, n_{d} as n from named where p_{d} > 0)) as all_{d}, "
                      f"(select coalesce(sum(tokens), 0) from named where n_{d} = 0) as free_{d}" for d in dims)
    goals = ", ".join(f"case when n_{d} > 0 then n_{d} / all_{d} * (total - free_{d}) else p_{d} end as g_{d}" for d in dims)
    step = "rounds"
    for d in dims:
        step = f"(select * replace (w * r * g_{d} / sum(w) over (partition by r, cell_{d}) as w) from {step})"
    kept = ", ".join(f"g_{d}" for d in dims)
    missed = " union all ".join(
        f"select r, abs(sum(w) over (partition by r, cell_{d}) / sum(w) over (partition by r) - g_{d} / total) as gap from done" for d in dims)
    return f"""
with recursive d as (
  select doc_id, source, lang, n, topic, {', '.join(f"{case[x]} as cell_{x}" for x in dims)} from (
    select doc_id, source, lang, len(regexp_extract_all(coalesce(text, ''), '[^ \\t\\n\\v\\f\\r]+')) as n,
      case when contains(coalesce(text, ''), ' | ') then 'table'
           when contains(coalesce(text, ''), '%%%') or contains(coalesce(text, ''), '###') then 'symbols'
           when regexp_matches(coalesce(text, ''), '[A-Z]') and not regexp_matches(coalesce(text, ''), '[a-z]') then 'capitals'
           when contains(coalesce(text, ''), '@') then 'contact' else 'prose' end as topic
    from documents)
), cells as (select {keys}, cast(sum(n) as double) as tokens from d group by all),
named as (select *, sum(tokens) over () as total, {parts} from cells),
shared as (select *, {share} from named),
goals as (select *, {goals} from shared where tokens > 0),
rates as (select {rate!r} * (1 - i / {STEPS}::double) as r from range({STEPS}) t(i)),
rounds as (
  select 0 as k, r, {keys}, tokens, total, {kept}, tokens as w from goals, rates
  union all
  select k + 1, r, {keys}, tokens, total, {kept}, least(w, tokens) from (select * from {step} where k < {ROUNDS})),
done as (select * from rounds where k = {ROUNDS}),
missed as (select r, max(gap) as gap from ({missed}) group by r),
best as (select r from missed order by case when gap <= {WITHIN} then 0 else gap end, r desc limit 1),
prob as (select {keys}, round(w / tokens, 9) as probability from done join best using (r))
select doc_id, source, lang, topic, cast(n as bigint) as n_tokens, coalesce(probability, (select r from best), {rate!r}) as probability,
       coalesce(cast(('0x' || substr(md5(cast(doc_id as varchar)), 1, 8)) as bigint) / 4294967296.0
                < coalesce(probability, (select r from best), {rate!r}), false) as kept
from d left join prob using ({keys})
"""
