"""Filter slices: the same result under every combination of switchable filters.

One pass gives each row a mask of the switches it passes. The slices of a row follow from its mask,
so rows are aggregated by mask before anything is repeated per slice; `slice_key` is then an extra
group key of whatever follows.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import combinations
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dwellspark.operators.filters import (
    FilterSpec,
    config_only_filters,
    extreme_of,
    filter_specs,
    keep_expr,
)
from dwellspark.operators.tracking import (
    best_records,
    daily_states,
    lead_stage_records,
    levels_of,
    merged_states,
    record_keys,
)


def slice_key(names: Sequence[str]) -> str:
    return "+".join(sorted(names)) if names else "none"


def default_slice_key(filters: dict[str, dict[str, Any]]) -> str:
    specs = filter_specs(filters).values()
    return slice_key([s.name for s in specs if s.switchable and s.default_active])


def combine(filters: dict[str, dict[str, Any]]) -> list[list[str]]:
    """All combinations of switchable filters without two of one exclusive group."""
    specs = filter_specs(filters)
    names = [n for n, s in specs.items() if s.switchable and s.columns]
    out = []
    for size in range(len(names) + 1):
        for combo in combinations(names, size):
            groups = [specs[n].exclusive_group for n in combo if specs[n].exclusive_group]
            if len(groups) == len(set(groups)):
                out.append(list(combo))
    return out


def normalise_choice(filters: dict[str, dict[str, Any]], chosen: Sequence[str]) -> list[str]:
    """In an exclusive group only the filter chosen last stays."""
    specs = filter_specs(filters)
    last = {specs[n].exclusive_group: n for n in chosen if n in specs and specs[n].exclusive_group}
    return [
        n for n in dict.fromkeys(chosen)
        if n in specs and (not specs[n].exclusive_group or last[specs[n].exclusive_group] == n)
    ]


@dataclass(frozen=True)
class Masked:
    """Rows that can be in a slice, with `_mask`: what is needed to say in which ones.

    `keys` turns the mask into the keys of the slices of a row. Rows with equal masks are in the same
    slices, so the mask may take part in an aggregation in their place: there are never more masks
    than combinations of passed switches that occur.
    """

    rows: DataFrame
    keys: Column


def masked(df: DataFrame, filters: dict[str, dict[str, Any]]) -> Masked:
    """Filters that do not switch hold in every slice: includes first, then the excludes that are on."""
    specs = filter_specs(filters)
    base = config_only_filters(df, filters)
    fixed = [s for s in specs.values() if s.excludes and s.enabled and not s.switchable]
    combos = combine(filters)
    switches = list(dict.fromkeys(n for combo in combos for n in combo))
    if any(s.is_extreme for s in [*fixed, *(specs[n] for n in switches)]):
        return Masked(_by_combination(base, specs, fixed, combos), F.col("_mask"))
    # Which switches a row passes is one number; the slices that follow from it are known here.
    bits = {n: 1 << i for i, n in enumerate(switches)}
    mask = reduce(
        lambda a, b: a.bitwiseOR(b),
        (F.when(_passes(base, [specs[n]]), F.lit(bit)).otherwise(F.lit(0)) for n, bit in bits.items()),
        F.lit(0),
    )
    rows = base.filter(_passes(base, fixed)).withColumn("_mask", mask.cast("long"))
    needs = [{"need": sum(bits[n] for n in c), "slice_key": slice_key(c)} for c in combos]
    needed = F.from_json(F.lit(json.dumps(needs)), "array<struct<need:bigint,slice_key:string>>")
    inside = F.filter(needed, lambda n: n["need"].bitwiseAND(F.col("_mask")) == n["need"])
    return Masked(rows, F.transform(inside, lambda n: n["slice_key"]))


def slices(df: DataFrame, filters: dict[str, dict[str, Any]]) -> DataFrame:
    """Rows repeated once per slice they belong to, tagged `slice_key`."""
    found = masked(df, filters)
    return found.rows.withColumn("slice_key", F.explode(found.keys)).drop("_mask")


def sliced_records(
    df: DataFrame,
    filters: dict[str, dict[str, Any]],
    level: str = "status",
    product_mode: str = "group_product",
    dedup_agg: str = "max",
    seq: str = "seq",
) -> DataFrame:
    """One record per slice, lead and stage: `lead_stage_records` of `slices`, on the masks.

    Rows of a lead, stage and date are reduced to one state per mask first, with partial aggregates.
    The states are brought together by lead and stage, and only there a state is repeated for the
    slices that hold its mask; what is exchanged never grows with the number of slices. A median has
    no state that could be merged; it is taken from the repeated rows.
    """
    if dedup_agg == "median":
        return lead_stage_records(slices(df, filters), level, product_mode, dedup_agg, seq, ["slice_key"])
    found = masked(df, filters)
    group_only = product_mode == "group_only"
    parts = []
    for name in levels_of(level):
        states = daily_states(found.rows, name, group_only, dedup_agg, seq, ["_mask"])
        together = states.repartition(*record_keys(name, group_only))
        repeated = together.withColumn("slice_key", F.explode(found.keys)).drop("_mask")
        daily = merged_states(repeated, name, group_only, dedup_agg, ["slice_key"])
        parts.append(best_records(daily, name, group_only, ["slice_key"]))
    return reduce(DataFrame.unionByName, parts)


def _by_combination(
    base: DataFrame, specs: dict[str, FilterSpec], fixed: Sequence[FilterSpec], combos: Sequence[Sequence[str]]
) -> DataFrame:
    """Rows with the keys of their slices where an extreme depends on the filters before it.

    The extremes of all combinations are conditional aggregates of one pass. Only an extreme behind
    another extreme needs a further pass, so there are as many as extremes in one combination at most.
    """
    sequences = []
    for combo in combos:
        # Includes cut the rows before the excludes see them, each on the remainder.
        sequences.append(
            [specs[n] for n in combo if not specs[n].excludes]
            + sorted([specs[n] for n in combo if specs[n].excludes] + list(fixed), key=lambda s: s.name)
        )
    known: dict[tuple[str, ...], Column] = {}

    def extreme(path: tuple[str, ...]) -> Callable[[str], Column]:
        return lambda column: known[(*path, column)]

    def passes(members: Sequence[FilterSpec]) -> Column:
        """Combinations that begin alike share the extremes of what they have in common."""
        path = tuple(m.name for m in members)
        return _passes(base, members, [extreme(path[: i + 1]) for i in range(len(path))])

    for depth in range(max(sum(m.is_extreme for m in members) for members in sequences)):
        wanted: dict[tuple[str, ...], Column] = {}
        for members in sequences:
            at = [i for i, m in enumerate(members) if m.is_extreme]
            if depth >= len(at):
                continue
            spec, before = members[at[depth]], members[: at[depth]]
            path = tuple(m.name for m in [*before, spec])
            for column in (c for c in spec.columns if c in base.columns):
                value, pick = extreme_of(base, column, spec)
                wanted.setdefault((*path, column), pick(F.when(passes(before), value)))
        if not wanted:
            continue
        name = f"_extremes_{depth}"
        picked = base.agg(*[c.alias(f"x{i}") for i, c in enumerate(wanted.values())])
        row = picked.select(F.struct("*").alias("all")).scalar()
        base = base.withColumn(name, row)
        known |= {key: F.col(name)[f"x{i}"] for i, key in enumerate(wanted)}
    tags = [F.when(passes(members), F.lit(slice_key(combo))) for combo, members in zip(combos, sequences, strict=True)]
    tagged = base.withColumn("_mask", F.array_compact(F.array(*tags)))
    return tagged.drop(*[c for c in base.columns if c.startswith("_extremes_")])


def _passes(
    base: DataFrame, members: Sequence[FilterSpec], extremes: Sequence[Callable[[str], Column]] = ()
) -> Column:
    keeps = []
    for i, spec in enumerate(members):
        keep = keep_expr(base, spec, extremes[i] if extremes else None)
        if keep is None:
            # An include on a missing column empties its slice; an exclude has no effect.
            keep = F.lit(spec.excludes)
        keeps.append(F.coalesce(keep, F.lit(False)))
    return reduce(lambda a, b: a & b, keeps, F.lit(True))


def slice_catalog(spark, filters: dict[str, dict[str, Any]]) -> DataFrame:
    """One row per slice: key, filters in it, whether it is shown first."""
    default = default_slice_key(filters)
    rows = [
        (slice_key(c), len(c), " + ".join(sorted(c)) if c else "", slice_key(c) == default)
        for c in combine(filters)
    ]
    return spark.createDataFrame(
        rows, "slice_key string, filter_count int, active_filters string, is_default boolean"
    )
