"""Measure-by-dimension queries over the cubes, composed as one DataFrame."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from vigilframe.operators.filters import date_bounds, restrict
from vigilframe.plans.cubes import CUBES, Cube

Tables = Mapping[str, DataFrame] | Callable[[str], DataFrame]

_GRAINS = {"second", "minute", "hour", "day", "week", "month", "quarter", "year"}


def _member(name: str, kind: str) -> tuple[str, str]:
    """Cube and member of ``Cube.member``; the error lists what exists."""
    cube, _, member = name.partition(".")
    if cube not in CUBES:
        raise ValueError(f"{name} not found. Available cubes: {', '.join(CUBES)}")
    known = CUBES[cube].measures if kind == "measures" else CUBES[cube].dimensions
    if member not in known:
        listing = ", ".join(f"{cube}.{m}" for m in known)
        raise ValueError(f"{name} not found. Available {kind}: {listing}")
    return cube, member


def _truncate(time: Column, grain: str) -> Column:
    if grain not in _GRAINS:
        raise ValueError(f"unknown granularity {grain!r}; one of {sorted(_GRAINS)}")
    return F.date_trunc(grain, time).cast("timestamp_ntz")


def _condition(df: DataFrame, cube: Cube, spec: Mapping) -> Column:
    column = cube.dimensions[_member(spec["member"], "dimensions")[1]].column
    operator, values = spec["operator"], list(spec.get("values", []))
    kind = df.schema[column].dataType
    typed = [F.lit(v).cast(kind) for v in values]
    if operator == "equals":
        return F.col(column).isin(*typed)
    if operator == "afterDate":
        return F.col(column) > typed[0]
    if operator == "beforeDate":
        return F.col(column) < typed[0]
    raise ValueError(f"unknown filter operator {operator!r}; one of equals, afterDate, beforeDate")


def semantic_query(tables: Tables, query: Mapping, as_of: date | None = None, sep: str = ".") -> DataFrame:
    """Run ``{measures, dimensions, timeDimensions, filters, order, limit}`` on one cube.

    ``tables`` gives the DataFrame of a table name. Filters and date ranges are applied
    before grouping and reach the scan; only the columns of the used members are read.
    Result columns are named ``Cube.member`` (``sep`` replaces the dot).
    """
    measures = list(query.get("measures", []))
    dimensions = list(query.get("dimensions", []))
    times = list(query.get("timeDimensions", []))
    filters = list(query.get("filters", []))
    used = [_member(m, "measures") for m in measures]
    used += [_member(d, "dimensions") for d in dimensions]
    used += [_member(t["dimension"], "dimensions") for t in times]
    used += [_member(f["member"], "dimensions") for f in filters]
    cubes = {c for c, _ in used}
    if len(cubes) != 1:
        raise ValueError(f"a query uses members of exactly one cube, got {sorted(cubes)}")
    cube = CUBES[cubes.pop()]
    df = tables(cube.table) if callable(tables) else tables[cube.table]

    for spec in filters:
        df = df.filter(_condition(df, cube, spec))
    keys: dict[str, Column] = {}
    for name in dimensions:
        keys[name] = F.col(cube.dimensions[_member(name, "dimensions")[1]].column)
    for spec in times:
        column = cube.dimensions[_member(spec["dimension"], "dimensions")[1]].column
        if spec.get("dateRange"):
            df = restrict(df, column, date_bounds(spec["dateRange"], as_of))
        if spec.get("granularity"):
            keys[spec["dimension"]] = _truncate(F.col(column).cast("timestamp_ntz"), spec["granularity"])

    def label(name: str) -> str:
        return name.replace(".", sep)

    values = [cube.measures[_member(m, "measures")[1]].expression().alias(label(m)) for m in measures]
    grouping = [c.alias(label(n)) for n, c in keys.items()]
    if values and grouping:
        out = df.groupBy(*grouping).agg(*values)
    elif values:
        out = df.agg(*values)
    else:
        out = df.select(*grouping).distinct()
    return _ordered(out, query, set(measures) | set(keys), label)


def _ordered(out: DataFrame, query: Mapping, selected: set[str], label: Callable[[str], str]) -> DataFrame:
    order = query.get("order") or {}
    pairs = list(order.items()) if isinstance(order, Mapping) else [tuple(p) for p in order]
    by = []
    for name, direction in pairs:
        if name not in selected:
            raise ValueError(f"order by {name}, which the query does not select")
        column = F.col(f"`{label(name)}`")
        by.append(column.desc() if direction == "desc" else column.asc())
    if by:
        # The remaining columns break ties, so that a limit picks the same rows every time.
        chosen = {label(n) for n, _ in pairs}
        by += [F.col(f"`{c}`") for c in out.columns if c not in chosen] if query.get("limit") else []
        out = out.orderBy(*by)
    return out.limit(int(query["limit"])) if query.get("limit") else out


def cube_meta(spark: SparkSession) -> DataFrame:
    """All cubes with their measures and dimensions."""
    rows = []
    for name, cube in CUBES.items():
        rows += [(name, "measure", f"{name}.{m}", spec.kind, False) for m, spec in cube.measures.items()]
        rows += [(name, "dimension", f"{name}.{d}", spec.kind, spec.primary_key) for d, spec in cube.dimensions.items()]
    return spark.createDataFrame(rows, "cube string, member_kind string, name string, type string, primary_key boolean")
