"""Metric layer: declared tables, relationships, facts, dimensions, metrics.

``model.query(metrics=..., dimensions=..., facts=..., where=...)`` compiles to
ordinary DataFrame operations: joins to the parents the query actually
references (and no others) -> ``filter(where)`` -> ``groupBy(dimensions).agg(metrics)``,
or a plain ``select`` for a facts query. Catalyst optimises across the result
and whatever the caller wraps around it.

Rules checked on names before any Spark job runs:

* one measure table per model; metrics belong to it, so a measure of a parent
  table cannot be summed across a many-to-one join (no fan-out);
* ``facts`` and ``metrics`` cannot be combined; a facts query returns rows at
  the grain its dimensions determine, and its facts and dimensions must come
  from one table;
* ``where`` filters rows before aggregation (there is no having inside);
* metrics hold no window functions; shares and ranks wrap the result;
* fact and metric names share one namespace;
* members may be named unqualified when the name is unambiguous;
* rows whose foreign key is NULL (or matches no parent) drop out of results
  that reference the parent, unless ``keep_unmatched=True``;
* a parent reached through one relationship declared complete (every child
  key has a parent row, backed by an error-severity orphan check) whose
  referenced members are all denormalised onto the measure table is read from
  the measure table, so no join (no shuffle of the fact) is planned for it;
* a direct parent that only adds attributes of a grouped foreign key is joined
  after the aggregation, to the aggregated rows instead of every fact row.

``validate()`` runs the one data check: every parent is unique on its key.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayflow.operators.selection import Percentile, exact_percentile

Getter = Callable[[str], Column]


class SemanticError(ValueError):
    pass


@dataclass
class Table:
    alias: str
    load: Callable[[], DataFrame]
    primary_key: str
    derived: dict[str, Callable[[Getter], Column]] = field(default_factory=dict)
    # columns that identify a row together, besides the primary key
    grain: tuple[str, ...] = ()


@dataclass
class Relationship:
    child: str
    foreign_key: str
    parent: str
    parent_key: str
    # every child key has a parent row (no row can drop out through this join)
    complete: bool = False


@dataclass
class Model:
    name: str
    measure_table: str
    tables: dict[str, Table]
    relationships: list[Relationship]
    facts: dict[str, str]            # qualified name -> column of its table (plain or derived)
    dimensions: dict[str, str]       # qualified name -> column of its table (plain or derived)
    metrics: dict[str, Callable[[Getter], Column | Percentile]]   # qualified name -> aggregate over measure-table columns
    # parent member -> column of the measure table holding the same value (denormalised onto the fact)
    denormalized: dict[str, str] = field(default_factory=dict)

    def __post_init__(self):
        if self.measure_table not in self.tables:
            raise SemanticError(f"{self.name}: measure table {self.measure_table!r} is not declared")
        for q in self.metrics:
            t, _ = _split(q)
            if t != self.measure_table:
                raise SemanticError(f"{self.name}: metric {q!r} is on {t!r}; metrics belong to the measure "
                                    f"table {self.measure_table!r}")
        fact_short = {_split(q)[1] for q in self.facts}
        metric_short = {_split(q)[1] for q in self.metrics}
        clash = fact_short & metric_short
        if clash:
            raise SemanticError(f"{self.name}: names used as both fact and metric: {sorted(clash)}")
        for q in list(self.facts) + list(self.dimensions):
            t, _ = _split(q)
            if t not in self.tables:
                raise SemanticError(f"{self.name}: member {q!r} refers to undeclared table {t!r}")
        for q, col in self.denormalized.items():
            t, _ = _split(q)
            path = self._path_static(t)
            if len(path) != 1 or not path[0].complete:
                raise SemanticError(f"{self.name}: {q!r} can only be read from the measure table through one "
                                    "complete relationship")
        for r in self.relationships:
            if r.child not in self.tables or r.parent not in self.tables:
                raise SemanticError(f"{self.name}: relationship {r} names an undeclared table")
            if self.tables[r.parent].primary_key != r.parent_key:
                raise SemanticError(f"{self.name}: {r.parent}.{r.parent_key} is not the declared primary key")
        self._parent_of = {r.child + "->" + r.parent: r for r in self.relationships}

    # ---------------------------------------------------------- resolution
    def _resolve(self, name: str, pool: dict) -> str:
        if name in pool:
            return name
        if "." in name:
            raise SemanticError(f"{self.name}: unknown member {name!r}")
        hits = [q for q in pool if _split(q)[1] == name]
        if not hits:
            raise SemanticError(f"{self.name}: unknown member {name!r}")
        if len(hits) > 1:
            raise SemanticError(f"{self.name}: {name!r} is ambiguous between {sorted(hits)}; qualify it")
        return hits[0]

    def _path_static(self, target: str) -> list[Relationship]:
        return [r for r in self.relationships if r.child == self.measure_table and r.parent == target]

    def _path(self, target: str) -> list[Relationship]:
        """Relationships leading from the measure table to ``target``. Two ways to one parent can name different rows, so a
        parent that is reached in two ways is an error."""
        if target == self.measure_table:
            return []
        found, open_ = [], [[r] for r in self.relationships if r.child == self.measure_table]
        while open_:
            path = open_.pop()
            if path[-1].parent == target:
                found.append(path)
                continue
            passed = {self.measure_table, *(r.parent for r in path)}
            open_ += [[*path, r] for r in self.relationships if r.child == path[-1].parent and r.parent not in passed]
        if not found:
            raise SemanticError(f"{self.name}: no relationship path from {self.measure_table!r} to {target!r}")
        if len(found) > 1:
            ways = sorted(" -> ".join([self.measure_table, *(f"{r.parent} ({r.foreign_key})" for r in p)]) for p in found)
            raise SemanticError(f"{self.name}: {target!r} is reached in {len(found)} ways: {'; '.join(ways)}")
        return found[0]

    def _table_frame(self, alias: str) -> DataFrame:
        """The table with its derived members, every column prefixed by the
        table alias, in one projection (one analysis pass)."""
        t = self.tables[alias]
        df = t.load()
        getter = lambda c: F.col(c)
        base = [F.col(c).alias(f"{alias}__{c}") for c in df.columns if c not in t.derived]
        derived = [make(getter).alias(f"{alias}__{name}") for name, make in t.derived.items()]
        return df.select(*base, *derived)

    # -------------------------------------------------------------- query
    def _frame(self, dims: list[str], fcts: list[str], mets: list[str], where: Callable[[Getter], Column] | None, how: str,
               join_late: bool = True) -> tuple[DataFrame, Callable[[str], Column], list[str]]:
        """The joined and filtered rows of a query, the column of each member in them, and the parents left to join after the
        aggregation."""
        referenced: set[str] = {_split(q)[0] for q in dims + fcts}
        where_tables: set[str] = set()

        # members of a parent reachable through one complete relationship, all of them denormalised onto
        # the measure table, are read from the measure table: the join (a shuffle of the fact when the
        # parent is too large to broadcast) is not planned
        wanted: dict[str, set] = {}
        for q in dims + fcts:
            wanted.setdefault(_split(q)[0], set()).add(q)
        if where is not None:
            probe: set = set()

            def probe_getter(name: str) -> Column:
                probe.add(self._resolve(name, {**self.dimensions, **self.facts}))
                return F.lit(None)

            where(probe_getter)
            for q in probe:
                wanted.setdefault(_split(q)[0], set()).add(q)
        served = {t for t, qs in wanted.items()
                  if t != self.measure_table and (mets or self.measure_table in wanted)
                  and all(q in self.denormalized for q in qs)}

        def column_of(q: str) -> Column:
            t, _ = _split(q)
            if t in served:
                return F.col(f"{self.measure_table}__{self.denormalized[q]}")
            return F.col(f"{t}__{self.dimensions.get(q) or self.facts.get(q)}")

        def where_getter(name: str) -> Column:
            q = self._resolve(name, {**self.dimensions, **self.facts})
            where_tables.add(self.measure_table if _split(q)[0] in served else _split(q)[0])
            return column_of(q)

        where_col = where(where_getter) if where is not None else None
        referenced = {self.measure_table if t in served else t for t in referenced}
        referenced |= where_tables
        if mets:
            referenced.add(self.measure_table)
        base_alias = self.measure_table if (mets or self.measure_table in referenced) else None
        if base_alias is None:
            # a facts/dimensions query on one non-measure table reads that table alone
            base_alias = next(iter(referenced))
        # Join after aggregating: a direct parent whose referenced members are all dimensions, that no filter
        # and no further parent needs, and whose foreign key is itself a grouping key, adds only attributes
        # that depend on that key. The aggregate is computed on the fact alone and the parent joined to the
        # (much smaller) result, instead of joining every fact row before the aggregation.
        late: list[str] = []
        if mets and join_late:
            for t in sorted(referenced - {self.measure_table}):
                path = self._path(t)
                if len(path) != 1 or t in where_tables:
                    continue
                fk = path[0].foreign_key
                fk_grouped = any(_split(q)[0] == self.measure_table and self.dimensions.get(q) == fk for q in dims)
                only_dims = all(q in self.dimensions for q in wanted.get(t, ()))
                needed_by_others = any(t in [r.parent for r in self._path(u)[:-1]] for u in referenced if u != t)
                if fk_grouped and only_dims and not needed_by_others:
                    late.append(t)
        frame = self._table_frame(base_alias)
        joined = {base_alias}
        for t in sorted(referenced - {base_alias} - set(late), key=lambda a: len(self._path(a))):
            for r in self._path(t):
                if r.parent in joined:
                    continue
                parent = self._table_frame(r.parent)
                frame = frame.join(parent, F.col(f"{r.child}__{r.foreign_key}") == F.col(f"{r.parent}__{r.parent_key}"),
                                   how)
                joined.add(r.parent)
        if where_col is not None:
            frame = frame.filter(where_col)
        return frame, column_of, late

    def query(self, metrics: Sequence[str] = (), dimensions: Sequence[str] = (), facts: Sequence[str] = (),
              where: Callable[[Getter], Column] | None = None, keep_unmatched: bool = False) -> DataFrame:
        if metrics and facts:
            raise SemanticError(f"{self.name}: facts and metrics cannot be combined in one query")
        if not metrics and not facts and not dimensions:
            raise SemanticError(f"{self.name}: empty query")
        dims = [self._resolve(d, self.dimensions) for d in dimensions]
        fcts = [self._resolve(f, self.facts) for f in facts]
        mets = [self._resolve(m, self.metrics) for m in metrics]
        if fcts:
            owners = {_split(q)[0] for q in dims + fcts}
            if len(owners) > 1:
                raise SemanticError(f"{self.name}: facts and dimensions of one facts query must come from "
                                    f"one table, got {sorted(owners)}")
            table = self.tables[owners.pop()]
            asked = {self.dimensions[q] for q in dims}
            if table.primary_key not in asked and not (table.grain and asked.issuperset(table.grain)):
                raise SemanticError(f"{self.name}: a facts query needs the key {table.primary_key!r} of its table "
                                    "among its dimensions")

        how = "left" if keep_unmatched else "inner"
        frame, column_of, late = self._frame(dims, fcts, mets, where, how)

        def out_name(q: str) -> str:
            return _split(q)[1]

        dim_cols = [column_of(q).alias(out_name(q)) for q in dims]
        if fcts:
            fact_cols = [column_of(q).alias(out_name(q)) for q in fcts]
            return frame.select(*dim_cols, *fact_cols)
        getter = lambda c: F.col(f"{self.measure_table}__{c}")
        agg_cols, percentiles = [], {}
        for q in mets:
            expr = self.metrics[q](getter)
            if isinstance(expr, Percentile):
                percentiles[out_name(q)] = expr
                continue
            if "OVER (" in str(expr).upper():
                raise SemanticError(f"{self.name}: metric {q!r} holds a window function")
            agg_cols.append(expr.alias(out_name(q)))
        if not mets:
            return frame.select(*dim_cols).distinct()
        early = [q for q in dims if _split(q)[0] not in late]
        out = self._aggregate(frame, {out_name(q): column_of(q) for q in early}, agg_cols, percentiles)
        for t in late:
            r = self._path(t)[0]
            fk_out = next(out_name(q) for q in early
                          if _split(q)[0] == self.measure_table and self.dimensions.get(q) == r.foreign_key)
            parent = self._table_frame(t)
            out = out.join(parent, F.col(fk_out) == F.col(f"{t}__{r.parent_key}"), how)
        final_dims = [column_of(q).alias(out_name(q)) if _split(q)[0] in late else F.col(out_name(q)) for q in dims]
        return out.select(*final_dims, *[F.col(out_name(q)) for q in mets])

    def query_grains(self, metrics: Sequence[str], grains: Sequence[Sequence[str]],
                     where: Callable[[Getter], Column] | None = None, keep_unmatched: bool = False) -> DataFrame:
        """The metrics at several grains (lists of dimensions) from one scan and one set of joins: column ``grain`` (the names of the
        grain's dimensions, comma-separated; empty for the total), all dimensions (null outside a row's grain), metrics.

        Each grain's rows equal ``query(metrics, grain, where)`` when every grain's dimensions reach the same parents; a
        parent joined for one grain drops rows without it from all of them, so grains that need different parents are an
        error unless ``keep_unmatched`` keeps such rows or the parent is complete."""
        if not metrics or not grains:
            raise SemanticError(f"{self.name}: grains need metrics and at least one list of dimensions")
        mets = [self._resolve(m, self.metrics) for m in metrics]
        asked = [[self._resolve(d, self.dimensions) for d in grain] for grain in grains]
        if len({frozenset(g) for g in asked}) < len(asked):
            raise SemanticError(f"{self.name}: the same grain is asked for twice")
        dims = list(dict.fromkeys(q for grain in asked for q in grain))
        names = {q: _split(q)[1] for q in dims}
        if len(set(names.values())) < len(dims):
            raise SemanticError(f"{self.name}: two dimensions have the same name")
        if not keep_unmatched:
            lossy = [{r.parent for q in grain for r in self._path(_split(q)[0]) if not r.complete} for grain in asked]
            if any(x != lossy[0] for x in lossy):
                raise SemanticError(f"{self.name}: the grains reach different parents ({sorted(set().union(*lossy))}), which can drop rows")
        frame, column_of, _ = self._frame(dims, [], mets, where, "left" if keep_unmatched else "inner", join_late=False)
        getter = lambda c: F.col(f"{self.measure_table}__{c}")
        made = {q: self.metrics[q](getter) for q in mets}
        plain = [e.alias(_split(q)[1]) for q, e in made.items() if not isinstance(e, Percentile)]
        rows = frame.select("*", *(column_of(q).alias(n) for q, n in names.items()))
        number = F.grouping_id() if dims else F.lit(0)
        # bit i of the grouping id (from the left) is set where dimension i is not part of the grain
        code = {",".join(names[q] for q in grain): sum(1 << (len(dims) - 1 - i) for i, q in enumerate(dims) if q not in grain) for grain in asked}
        label = lambda c: F.coalesce(*(F.when(c == v, F.lit(g)) for g, v in code.items()))
        sets = [[F.col(names[q]) for q in grain] for grain in asked]
        if dims:
            out = rows.groupingSets(sets, *(F.col(n) for n in names.values())).agg(number.alias("_grain"), *plain)
        else:
            out = rows.agg(number.alias("_grain"), *plain)
        out = out.select(label(F.col("_grain")).alias("grain"), *names.values(), *(c for c in out.columns if c not in names.values() and c != "_grain"))
        for q, p in made.items():
            if isinstance(p, Percentile):
                parts = []
                for grain, g in zip(asked, code):
                    one = exact_percentile(rows.select(*(names[d] for d in grain), p.value.alias("_measure")), [names[d] for d in grain], "_measure", p.fraction, _split(q)[1])
                    parts.append(one.select(F.lit(g).alias("_of_grain"), *((F.col(n) if d in grain else F.lit(None).cast(rows.schema[n].dataType)).alias(f"_of_{n}")
                                                                           for d, n in names.items()), _split(q)[1]))
                side = reduce(DataFrame.unionByName, parts)
                on = [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in ("grain", *names.values())]
                out = out.join(side, on).drop("_of_grain", *(f"_of_{n}" for n in names.values()))
        return out.select("grain", *names.values(), *(_split(q)[1] for q in mets))

    @staticmethod
    def _aggregate(frame: DataFrame, dims: dict[str, Column], aggregates: list[Column],
                   percentiles: dict[str, Percentile]) -> DataFrame:
        """Metrics by dimension. Exact percentiles are selected without gathering a group and joined to the others."""
        keys = list(dims)
        by = [c.alias(n) for n, c in dims.items()]
        out = None
        if aggregates or not percentiles:
            out = frame.groupBy(*by).agg(*aggregates) if dims else frame.agg(*aggregates)
        for name, p in percentiles.items():
            one = exact_percentile(frame.select(*by, p.value.alias("_measure")), keys, "_measure", p.fraction, name)
            if out is None:
                out = one
            elif not keys:
                out = out.withColumn(name, one.scalar())
            else:
                side = one.select(*(F.col(k).alias(f"_of_{k}") for k in keys), name)
                out = out.join(side, [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys]).drop(*(f"_of_{k}" for k in keys))
        return out

    def validate(self) -> list[str]:
        """Declared keys that are not unique, and relationships declared complete that are not; empty = valid."""
        problems = []
        for r in self.relationships:
            if r.complete:
                child = self.tables[r.child].load().select(F.col(r.foreign_key).alias("_fk")).distinct()
                parent = self.tables[r.parent].load().select(F.col(r.parent_key).alias("_fk"))
                if not child.join(parent, "_fk", "left_anti").isEmpty():
                    problems.append(f"{self.name}: {r.child}.{r.foreign_key} has values without a row in {r.parent}")
        for t in self.tables.values():
            dup = t.load().groupBy(t.primary_key).count().filter(F.col("count") > 1).limit(1).count()
            if dup:
                problems.append(f"{self.name}.{t.alias}: primary key {t.primary_key!r} is not unique")
        return problems


def _split(q: str) -> tuple[str, str]:
    t, _, n = q.partition(".")
    if not n:
        raise SemanticError(f"member {q!r} must be qualified as table.name in the declaration")
    return t, n
