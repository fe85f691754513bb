"""Factor expressions to staged DataFrame plans.

Equal parts of all expressions are one node. A node with window functions (or a kernel) becomes a
column in the stage after those it reads, row-wise nodes are inlined; so a stage is one select, in
which Spark shares the sort of every window specification, and many factors share a scan.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factorloom.functions import kernels, ops
from factorloom.functions.common import finite, group_count, task_count
from factorloom.functions.ops import INST, OPS, TS
from factorloom.plans import stubs
from factorloom.plans.dsl import DslError, Node, columns_of, parse

SIGNATURES = {name: o.signature for name, o in OPS.items() if name[0] != "_" and name != "bar_index"} | stubs.SIGNATURES


def compile_text(text: str) -> Node:
    return parse(text, SIGNATURES)


def expand(node: Node) -> Node:
    """node with its compositions written out."""
    args = tuple(map(expand, node.args))
    o = OPS.get(node.op)
    if o is not None and o.kind == "MACRO":
        return expand(o.build(*args, **dict(node.params)))
    if node.op in stubs.SIGNATURES:
        raise NotImplementedError(f"operator {node.op} has a name but no semantics")
    return Node(node.op, args, node.params)


def panel(df: DataFrame, timestamp: str | Column, instrument: str | Column, columns: Mapping[str, Column | str], keep_last_by: Column | None = None) -> DataFrame:
    """The canonical panel: timestamp, instrument (text), and columns with NaN and infinity as null.

    Numbers become double; text columns (groups) stay. Rows without timestamp or instrument are left
    out. Of repeated keys the last by keep_last_by counts; without it, the greatest row by its values.
    """
    ts, inst = (F.col(c) if isinstance(c, str) else c for c in (timestamp, instrument))
    cols = {n: F.col(c) if isinstance(c, str) else c for n, c in columns.items()}
    out = df.select(ts.alias(TS), inst.cast("string").alias(INST), *[c.alias(n) for n, c in cols.items()], (keep_last_by if keep_last_by is not None else F.lit(0)).alias("_last"))
    kinds = dict(out.dtypes)
    out = out.select(TS, INST, "_last", *[F.col(n) if kinds[n] in ("string", "array<float>", "array<double>") else finite(n).alias(n) for n in cols])
    out = out.filter(F.col(TS).isNotNull() & F.col(INST).isNotNull())
    pick = F.max(F.struct("_last", *cols)).alias("_p")
    return out.groupBy(TS, INST).agg(pick).select(TS, INST, *[F.col("_p")[n].alias(n) for n in cols])


class Plan:
    """The stages of some factors, before they are put on a panel."""

    def __init__(self, factors: Mapping[str, Node | str]) -> None:
        self.roots = {n: expand(compile_text(f) if isinstance(f, str) else f) for n, f in factors.items()}
        self.level: dict[Node, int] = {}
        self.stages: dict[int, list[Node]] = {}
        for r in self.roots.values():
            self._place(r)
        self.names = {n: f"_n{i}" for i, n in enumerate(x for k in sorted(self.stages) for x in self.stages[k])}

    def _place(self, node: Node) -> int:
        """The stage after which node's value is there."""
        if node in self.level:
            return self.level[node]
        deepest = max(map(self._place, node.args), default=0)
        if node.op in ("col", "lit") or OPS[node.op].kind == "ROW":
            self.level[node] = deepest
        else:
            self.level[node] = deepest + 1
            self.stages.setdefault(deepest + 1, []).append(node)
        return self.level[node]

    def columns(self) -> set[str]:
        return set().union(*map(columns_of, self.roots.values())) if self.roots else set()

    def explain(self) -> str:
        """The stages as text."""
        lines = [f"stage {k}: {self.names[n]} = {n}" for k in sorted(self.stages) for n in self.stages[k]]
        return "\n".join([*lines, *(f"{n} = {r}" for n, r in self.roots.items())])

    def _value(self, node: Node) -> Column:
        if node in self.names:
            return F.col(self.names[node])
        if node.op == "col":
            return F.col(f"`{node.param('name')}`")
        if node.op == "lit":
            v = node.param("value")
            return F.lit(float(v)) if isinstance(v, (int, float)) and not isinstance(v, bool) else F.lit(v)
        return OPS[node.op].build(*map(self._value, node.args), **dict(node.params))

    def _needed(self, after: int) -> list[str]:
        """Columns that the stages after this one read."""
        need: set[str] = set()

        def walk(x: Node) -> None:
            if x in self.names and self.level[x] <= after:
                need.add(self.names[x])
            elif x.op == "col":
                need.add(x.param("name"))
            else:
                for a in x.args:
                    walk(a)

        for k, nodes in self.stages.items():
            for n in nodes if k > after else []:
                for a in n.args:
                    walk(a)
        for r in self.roots.values():
            walk(r)
        return sorted(need)

    def on(self, df: DataFrame, keep: Iterable[str] = ()) -> DataFrame:
        """timestamp, instrument, keep and a column for each factor, NaN and infinity being null."""
        keep = list(keep)
        missing = (self.columns() | set(keep)) - set(df.columns)
        if missing:
            raise DslError(f"the panel has no column {', '.join(sorted(missing))}")
        df = df.select(TS, INST, *sorted(self.columns() | set(keep)))
        for k in sorted(self.stages):
            windows = [n for n in self.stages[k] if OPS[n.op].kind == "WIN"]
            recursive = [n for n in self.stages[k] if OPS[n.op].kind == "KERNEL"]
            carry = sorted({*self._needed(k), *keep} - {self.names[n] for n in self.stages[k]})
            inputs = {a: f"_in{i}" for i, a in enumerate(dict.fromkeys(a for n in recursive for a in n.args))}
            # arguments of window functions are made columns first, so that no expression is computed per frame
            parts = dict.fromkeys(a for n in windows for a in n.args if a not in self.names and a.op not in ("col", "lit"))
            held = {a: f"_a{i}" for i, a in enumerate(parts)}
            df = df.select(TS, INST, *[c for c in df.columns if c not in (TS, INST)], *[self._value(a).alias(c) for a, c in {**inputs}.items()], *[self._value(a).alias(c) for a, c in held.items()])
            arg = lambda a: F.col(held[a]) if a in held else self._value(a)  # noqa: B023, E731
            made = [OPS[n.op].build(*map(arg, n.args), **dict(n.params)).alias(self.names[n]) for n in windows]
            df = df.select(TS, INST, *carry, *inputs.values(), *made)
            if recursive:
                df = run_kernels(df, [(self.names[n], n.op, [inputs[a] for a in n.args], dict(n.params)) for n in recursive], drop=list(inputs.values()))
        out = {n: ops.ok(self._value(r).cast("double")).alias(n) if r.op != "col" else self._value(r).alias(n) for n, r in self.roots.items()}
        return df.select(TS, INST, *keep, *out.values())


BLOCK_CELLS = 4_000_000  # values of one dense array


def run_kernels(df: DataFrame, calls: list[tuple[str, str, list[str], dict]], drop: list[str] = ()) -> DataFrame:
    """df with a double column for each call (name, kernel, input columns, parameters); drop's columns left out.

    Instruments are hashed into groups of a bounded size; the bars of an instrument stay together, as
    a recursion along time needs, and a group's instruments run side by side in dense blocks.
    """
    rest = [c for c in df.columns if c not in drop]
    schema = df.select(*rest).schema
    for name, *_ in calls:
        schema = schema.add(name, "double")
    groups = group_count(df, bytes_each=32 << 20)
    keyed = df.withColumn("_g", F.pmod(F.xxhash64(INST), F.lit(groups)))
    order = [c for c in keyed.columns if c != "_g"]
    functions = {k: kernels.KERNELS[k] for _, k, _, _ in calls}

    def run(table: pa.Table) -> pa.Table:
        table = table.select(order).sort_by([(INST, "ascending"), (TS, "ascending")])
        code = table[INST].combine_chunks().dictionary_encode().indices.to_numpy()
        starts = np.flatnonzero(np.r_[True, code[1:] != code[:-1]]) if len(code) else np.array([], int)
        length = np.diff(np.r_[starts, len(code)])
        results = {name: np.full(len(code), np.nan) for name, *_ in calls}
        by_length = np.argsort(length, kind="stable")  # instruments of like length share a block
        lo = 0
        while lo < len(by_length):
            hi = lo + 1
            while hi < len(by_length) and (hi + 1 - lo) * length[by_length[hi]] <= BLOCK_CELLS:
                hi += 1
            block = by_length[lo:hi]
            lo = hi
            n = length[block]
            row = np.repeat(np.arange(len(block)), n)
            col = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            at = np.repeat(starts[block], n) + col
            dense = {}
            for c in {c for _, _, inputs, _ in calls for c in inputs}:
                dense[c] = np.full((len(block), int(n.max())), np.nan)
                dense[c][row, col] = table[c].to_numpy()[at]
            for name, kernel_name, inputs, params in calls:
                with np.errstate(all="ignore"):
                    results[name][at] = functions[kernel_name](*(dense[c] for c in inputs), **params)[row, col]
        out = table.select(rest)
        for name, *_ in calls:
            out = out.append_column(name, pa.array(results[name], from_pandas=True))
        return out

    return keyed.repartition(task_count(groups, df), "_g").groupBy("_g").applyInArrow(run, schema)


def compute(df: DataFrame, factors: Mapping[str, Node | str], keep: Iterable[str] = ()) -> DataFrame:
    """All factors over a canonical panel, in as few stages as they need."""
    return Plan(factors).on(df, keep)
