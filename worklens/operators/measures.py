"""Named measures over the star schema, evaluated in a filter context.

A measure is an expression over *atoms*. An atom is one additive aggregate of one fact; it knows
which date role it uses and which columns its own condition takes over from the context. Atoms that
share a fact, role and context are computed together in one aggregation.

Facts are aggregated to the key of the next table before they meet it (visit -> task -> project), so
a task or project that owns a large share of the rows is one row per group when it is joined.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from worklens.plans.gold import Model

PROJECT, TASK, VISIT = "dim_projeto", "fato_tarefa", "fato_passagem_status"
PERSON, STAGE, DAY, PARAMETERS = "dim_pessoa", "dim_status", "dim_data", "ref_parametros"

# fixed values: tables whose filters reach each fact
REACH = {
    PROJECT: {PROJECT},
    TASK: {TASK, PROJECT, PERSON, STAGE, DAY},
    VISIT: {VISIT, TASK, PROJECT, PERSON, STAGE, DAY},
    PARAMETERS: {PARAMETERS},
}
# fixed values: columns another column is sorted by
SORT_BY = {
    "dim_data.mes_ano": "dim_data.ano_mes",
    "dim_data.dia_semana_nome": "dim_data.dia_semana",
    "dim_status.status": "dim_status.ordem",
    "fato_passagem_status.status": "fato_passagem_status.ordem_etapa",
}


@dataclass(frozen=True)
class Atom:
    """One aggregate: ``first`` over fact rows, ``merge`` ('sum' or 'max') over partial results.

    ``date`` is the date column the calendar filters through: of the task, or of the visit itself.
    ``per_task`` makes ``first`` a value per task, so merging counts tasks instead of rows.
    ``median_of`` asks for the exact median of a two-decimal column instead.
    """

    fact: str
    first: str = "sum(1)"
    merge: str = "sum"
    date: str = "data_criacao"
    overrides: frozenset[str] = frozenset()
    per_task: bool = False
    median_of: str | None = None


def _taken(fact: str, columns: Sequence[str]) -> frozenset[str]:
    return frozenset(f"{fact}.{c}" for c in columns)


def rows(fact: str, where: str = "true", takes: Sequence[str] = (), **options) -> Atom:
    """Rows meeting a condition; none is BLANK, not zero."""
    return Atom(fact, f"sum(CASE WHEN {where} THEN 1 END)",
                overrides=_taken(fact, takes), **options)


def total(fact: str, value: str, where: str = "true", takes: Sequence[str] = ()) -> Atom:
    return Atom(fact, f"sum(CASE WHEN {where} THEN {value} END)", overrides=_taken(fact, takes))


def _whole_hundredths(value: str) -> str:
    """A two-decimal number times 100 is an integer but for its last bits, which ``rint`` drops."""
    return f"CAST(rint({value} * 100) AS BIGINT)"


def hundredths_total(
    fact: str, value: str, where: str = "true", takes: Sequence[str] = ()
) -> Atom:
    """Sum of a two-decimal column as whole hundredths: the same whatever the row order."""
    return total(fact, _whole_hundredths(value), where, takes)


@dataclass(frozen=True)
class Measure:
    name: str
    atoms: tuple[str, ...]
    value: Callable[[], Column]
    is_text: bool = False
    dense: bool = False  # has a value even where every atom is BLANK


@dataclass(frozen=True)
class Context:
    """What a measure is looked at through: axis columns, category filters and a security role."""

    by: tuple[str, ...] = ()
    filters: Mapping[str, Sequence] = field(default_factory=dict)
    portfolio: str | None = None


def _split(ref: str) -> tuple[str, str]:
    table, name = ref.split(".", 1)
    return table, name


def _axis(i: int) -> str:
    return f"_axis{i}"


class _Group:
    """Atoms of one fact that see the same context, and the columns that context brings."""

    def __init__(self, model: Model, context: Context, sample: Atom):
        self.model, self.fact, self.date = model, sample.fact, sample.date
        reach = REACH[sample.fact]
        visible = lambda ref: _split(ref)[0] in reach and ref not in sample.overrides
        self.by = {i: ref for i, ref in enumerate(context.by) if visible(ref)}
        self.filters = {ref: v for ref, v in context.filters.items() if visible(ref)}
        self.portfolio = context.portfolio if PROJECT in reach else None

    def touches(self, table: str) -> bool:
        refs = [*self.by.values(), *self.filters]
        return any(_split(r)[0] == table for r in refs) or (
            table == PROJECT and self.portfolio is not None)

    def restricted(self, table: str) -> bool:
        return any(_split(r)[0] == table for r in self.filters) or (
            table == PROJECT and self.portfolio is not None)

    def axes(self, table: str) -> list[str]:
        return [_axis(i) for i, ref in self.by.items() if _split(ref)[0] == table]

    def filtered(self, table: str) -> DataFrame:
        """A table under the context's filters on it, with its axis columns added."""
        df = self.model[table]
        for ref, values in self.filters.items():
            if _split(ref)[0] == table:
                df = df.where(F.col(_split(ref)[1]).isin(list(values)))
        if table == PROJECT and self.portfolio is not None:
            df = df.where(F.col("portfolio") == self.portfolio)
        axes = {
            _axis(i): F.col(_split(ref)[1]) for i, ref in self.by.items()
            if _split(ref)[0] == table
        }
        return df.withColumns(axes) if axes else df

    def key_rows(self, table: str, key: str, as_key: str) -> DataFrame:
        return self.filtered(table).select(F.col(key).alias(as_key), *self.axes(table))

    def how(self, table: str) -> str:
        """Unmatched facts stay under a blank axis value until something filters the table."""
        return "inner" if self.restricted(table) else "left"

    def with_small(self, df: DataFrame, table: str, key: str, via: str) -> DataFrame:
        """Bring in a table of fixed size (seven stages, calendar days) before any aggregation.

        A date has at most 3,652,059 values, and the report's calendar a few thousand.
        """
        if not self.touches(table):
            return df
        small = F.broadcast(self.key_rows(table, key, "_key"))
        joined = df.join(small, F.col(via) == F.col("_key"), self.how(table))
        return joined.drop("_key")

    def task_side(self, with_date: bool) -> DataFrame:
        df = self.filtered(TASK)
        df = self.with_small(df, STAGE, "status", "status")
        if with_date:
            df = self.with_small(df, DAY, "data", self.date)
        return df

    def aggregate(self, atoms: Mapping[str, Atom]) -> DataFrame:
        """One row per axis value with every atom of the group."""
        median = next((a.median_of for a in atoms.values() if a.median_of), None)
        if median:  # pre-counted values keep the median exact and its state small
            (name, _), = atoms.items()
            counted = {"_copies": Atom(self.fact, "sum(1)")}
            value = F.expr(_whole_hundredths(median))
            parts = self._collapse(counted, {"_value": value})
            middle = F.percentile("_value", F.lit(0.5), F.col("_copies")) / 100
            known = parts.where(F.col("_value").isNotNull())
            return known.groupBy(*map(_axis, self.by)).agg(middle.alias(name))
        return self._collapse(atoms, {})

    def _collapse(self, atoms: Mapping[str, Atom], extra: Mapping[str, Column]) -> DataFrame:
        first = [F.expr(a.first).alias(name) for name, a in atoms.items()]
        added = [value.alias(name) for name, value in extra.items()]
        merge = [getattr(F, a.merge)(name).alias(name) for name, a in atoms.items()]
        hops = []  # link column of the fact side, table, its key
        if self.fact != PROJECT and self.touches(PROJECT):
            hops.append(("projeto_id", PROJECT, "projeto_id"))
        if self.fact != PROJECT and self.touches(PERSON):
            hops.append(("responsavel_id", PERSON, "pessoa_id"))
        links = [link for link, _, _ in hops]

        if self.fact == VISIT:
            own_date = self.date == "data_entrada"
            visits = self.filtered(VISIT)
            if own_date:
                visits = self.with_small(visits, DAY, "data", "data_entrada")
            axes = self.axes(VISIT) + (self.axes(DAY) if own_date else [])
            through_task = bool(hops) or self.touches(TASK) or self.touches(STAGE) or (
                not own_date and self.touches(DAY))
            if not through_task and not any(a.per_task for a in atoms.values()):
                return visits.groupBy(*axes, *added).agg(*first)
            df = visits.groupBy("tarefa_id", *axes, *added).agg(*first)
            if through_task:
                task_axes = self.axes(TASK) + self.axes(STAGE)
                task_axes += [] if own_date else self.axes(DAY)
                tasks = self.task_side(not own_date).select("tarefa_id", *links, *task_axes)
                narrowed = any(
                    self.restricted(t) for t in (TASK, STAGE) + (() if own_date else (DAY,)))
                df = df.join(tasks, "tarefa_id", "inner" if narrowed else "left")
                axes += task_axes
            df = df.groupBy(*links, *axes, *extra).agg(*merge)
        else:
            if self.fact == TASK:
                df = self.task_side(True)
                axes = self.axes(TASK) + self.axes(STAGE) + self.axes(DAY)
            else:
                df = self.filtered(self.fact)
                axes = self.axes(self.fact)
            df = df.groupBy(*links, *axes, *added).agg(*first)

        for i, (link, table, key) in enumerate(hops):
            axes += self.axes(table)
            df = df.join(self.key_rows(table, key, link), link, self.how(table))
            df = df.groupBy(*links[i + 1:], *axes, *extra).agg(*merge)
        return df


def evaluate(
    model: Model, measures: Sequence[Measure], atoms: Mapping[str, Atom], context: Context
) -> DataFrame:
    """Measures of any grain on one axis, one row per axis value where any of them has a value.

    Per-fact results are lined up by a null-safe union and one small aggregation. An atom the axis
    does not reach, or whose condition takes the axis column over, has the same value on every row.
    Those, and measures that are never BLANK, also show axis values no fact has.
    """
    needed = sorted({a for m in measures for a in m.atoms})
    groups: dict[tuple, dict[str, Atom]] = {}
    for name in needed:
        atom = atoms[name]
        seen = tuple(r for r in (*context.by, *context.filters) if r not in atom.overrides)
        dated = atom.date if any(_split(r)[0] == DAY for r in seen) else ""
        key = (atom.fact, dated, seen, name if atom.median_of else "")
        groups.setdefault(key, {})[name] = atom

    names = [_axis(i) for i in range(len(context.by))]
    full: DataFrame | None = None
    partial: list[tuple[list[str], DataFrame, list[str]]] = []
    for members in groups.values():
        group = _Group(model, context, next(iter(members.values())))
        result = group.aggregate(members)
        if group.by:  # an axis value where every atom is BLANK is not there
            known = F.coalesce(*[F.col(m).cast("string") for m in members]).isNotNull()
            result = result.where(known)
        if len(group.by) == len(names):
            full = result if full is None else full.unionByName(result, allowMissingColumns=True)
        else:
            partial.append(([_axis(i) for i in group.by], result, list(members)))

    dense = any(m.dense for m in measures)
    if (partial or dense) and len({_split(ref)[0] for ref in context.by}) == 1:
        table = _split(context.by[0])[0]
        axis = _Group(model, context, Atom(table)) if table in REACH else None
        source = axis.filtered(table) if axis else _filtered_axis(model, context, table)
        keys = source.select(*names).distinct()
        full = keys if full is None else full.unionByName(keys, allowMissingColumns=True)
    if full is None:
        raise ValueError("no measure reaches every axis column: add one that does")

    present = [c for c in full.columns if c not in names]
    if present or not names:
        full = full.groupBy(*names).agg(*[F.max(c).alias(c) for c in present])
    for keys, result, members in partial:
        if keys:
            renamed = result.withColumnsRenamed({k: f"{k}_r" for k in keys})
            same = [F.col(k).eqNullSafe(F.col(f"{k}_r")) for k in keys]
            full = full.join(renamed, same, "left").drop(*[f"{k}_r" for k in keys])
        else:
            totals = result.select(F.struct(*members)).scalar()  # one subquery for all of them
            full = full.withColumn("_totals", totals).select(*full.columns, "_totals.*")

    shown = full.select(
        *[F.col(_axis(i)).alias(_split(ref)[1]) for i, ref in enumerate(context.by)],
        *[m.value().alias(m.name) for m in measures],
    )
    if not context.by:
        return shown
    return shown.where(F.coalesce(*[F.col(f"`{m.name}`").cast("string") for m in measures])
                       .isNotNull())


def _filtered_axis(model: Model, context: Context, table: str) -> DataFrame:
    """Axis values of a dimension that is no fact itself, under the filters on it."""
    df = model[table]
    for ref, values in context.filters.items():
        if _split(ref)[0] == table:
            df = df.where(F.col(_split(ref)[1]).isin(list(values)))
    return df.withColumns({_axis(i): F.col(_split(r)[1]) for i, r in enumerate(context.by)})


def ordered(result: DataFrame, ref: str, descending: bool = False) -> DataFrame:
    """Sort a result by an axis column through the column that carries its order."""
    key = _split(SORT_BY.get(ref, ref))[1]
    return result.orderBy(F.col(key).desc() if descending else F.col(key).asc())
