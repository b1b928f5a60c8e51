"""Stages with declared inputs and outputs, run in dependency order and skipped while nothing they depend on changed."""

from __future__ import annotations

import ast
import hashlib
import importlib.util
import inspect
import json
import textwrap
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession


class BuildError(RuntimeError):
    """A stage can't run, or did not keep its word."""


@dataclass(frozen=True)
class Stage:
    name: str
    run: Callable[..., dict[str, DataFrame]]
    reads: tuple[str, ...]
    writes: tuple[str, ...]
    params: tuple[str, ...] = ()
    always: bool = False


@dataclass
class Params:
    """Settings by dotted path; there is no silent default."""

    values: dict = field(default_factory=dict)

    def get(self, path: str):
        at = self.values
        for part in path.split("."):
            if not isinstance(at, dict) or part not in at:
                raise BuildError(f"parameter {path} is not set")
            at = at[part]
        return at


class Pipeline:
    def __init__(self, params: Params | None = None, sources: tuple[str, ...] | None = None) -> None:
        """With ``sources``, a stage may read those tables and what other stages write, and nothing else."""
        self.stages: dict[str, Stage] = {}
        self.params = params or Params()
        self.sources = sources

    def stage(self, *, reads: tuple[str, ...] = (), writes: tuple[str, ...], params: tuple[str, ...] = (), always: bool = False):
        """Register a function as a stage: it takes (spark, inputs by name, params by path) and returns its tables."""

        def keep(f):
            for table in writes:
                if self.sources is not None and table in self.sources:
                    raise BuildError(f"{table} is a source and is written by no stage")
                owner = next((s.name for s in self.stages.values() if table in s.writes), None)
                if owner:
                    raise BuildError(f"{table} is written by {owner} already")
            if f.__name__ in self.stages:
                raise BuildError(f"stage {f.__name__} exists already")
            self.stages[f.__name__] = Stage(f.__name__, f, tuple(reads), tuple(writes), tuple(params), always)
            return f

        return keep

    def needs(self, name: str) -> list[str]:
        """Stages that write what a stage reads; tables that no stage writes are sources."""
        by_table = {t: s.name for s in self.stages.values() for t in s.writes}
        return [by_table[t] for t in self.stages[name].reads if t in by_table]

    def plan(self, targets: list[str] | None = None) -> list[str]:
        """Stages to run in dependency order, else in order of registration; a cycle is an error."""
        out: list[str] = []
        trail: list[str] = []

        def visit(name: str) -> None:
            if name in out:
                return
            if name in trail:
                raise BuildError("stages in a circle: " + " -> ".join([*trail[trail.index(name) :], name]))
            if name not in self.stages:
                raise BuildError(f"no stage {name}")
            written = {t for s in self.stages.values() for t in s.writes}
            unknown = [t for t in self.stages[name].reads if self.sources is not None and t not in written and t not in self.sources]
            if unknown:
                raise BuildError(f"{name} reads {unknown[0]}, which is no source and no stage writes")
            trail.append(name)
            for n in self.needs(name):
                visit(n)
            trail.pop()
            out.append(name)

        for t in targets or list(self.stages):
            visit(t)
        return out

    def fingerprint(self, name: str, known: dict[str, str] | None = None) -> str:
        """Digest of a stage's code (formatting aside), the settings it declares, and its upstream fingerprints."""
        known = {} if known is None else known
        if name not in known:
            s = self.stages[name]
            code = _code(s.run)
            settings = json.dumps({p: self.params.get(p) for p in s.params}, sort_keys=True)
            above = [self.fingerprint(n, known) for n in self.needs(name)]
            known[name] = hashlib.sha256("\n".join([code, settings, *s.reads, *s.writes, *above]).encode()).hexdigest()
        return known[name]


def _imports(tree: ast.AST, module: str, package: bool) -> set[str]:
    """Names that a module's import statements may load, wherever in it they stand."""
    found = set()
    base = module.split(".") if package else module.split(".")[:-1]
    for node in ast.walk(tree):
        if isinstance(node, ast.Import):
            found.update(x.name for x in node.names)
        elif isinstance(node, ast.ImportFrom):
            above = base[: len(base) - node.level + 1] if node.level else []
            name = ".".join([*above, *([node.module] if node.module else [])])
            found.add(name)
            found.update(f"{name}.{x.name}" for x in node.names)
    return found


def _source(module: str) -> tuple[str, bool] | None:
    """A module's source and whether it is a package; none for what is no module or has no source."""
    try:
        spec = importlib.util.find_spec(module)
    except (ImportError, ValueError):
        return None
    if spec is None or not spec.origin or not spec.origin.endswith(".py"):
        return None
    with open(spec.origin, encoding="utf-8") as text:
        return text.read(), spec.submodule_search_locations is not None


def closure(module: str, source: Callable[[str], tuple[str, bool] | None] = _source) -> dict[str, str]:
    """The syntax trees of all modules that ``module`` reaches by imports within its own package and this one."""
    ours = {module.split(".")[0], __name__.split(".")[0]}
    trees: dict[str, str] = {}
    todo = [module]
    while todo:
        name = todo.pop()
        if name in trees or name.split(".")[0] not in ours:
            continue
        found = source(name)
        if found is None:
            continue
        tree = ast.parse(found[0])
        trees[name] = ast.dump(tree)
        todo += [x for x in _imports(tree, name, found[1])] + [name.rpartition(".")[0]] * ("." in name)
    return trees


def _code(f: Callable, source: Callable[[str], tuple[str, bool] | None] = _source) -> str:
    """The syntax tree of a function, of the functions of its module that it names, and of every other module its module reaches."""
    seen: dict[str, str] = {}

    def add(g: Callable) -> None:
        tree = ast.parse(textwrap.dedent(inspect.getsource(g)))
        for node in ast.walk(tree):
            if isinstance(node, ast.FunctionDef):
                node.decorator_list = []
        seen[g.__qualname__] = ast.dump(tree)
        for node in ast.walk(tree):
            if isinstance(node, ast.Name):
                other = getattr(g, "__globals__", {}).get(node.id)
                if inspect.isfunction(other) and other.__module__ == f.__module__ and other.__qualname__ not in seen:
                    add(other)

    add(f)
    others = closure(f.__module__, source)
    others.pop(f.__module__, None)
    return "\n".join([*(seen[k] for k in sorted(seen)), *(f"{k} {others[k]}" for k in sorted(others))])


LEDGER = "stage string, fingerprint string, rows long, ran_at string"


class Build:
    """Runs a pipeline over Parquet tables below one folder."""

    def __init__(self, spark: SparkSession, root: str, pipeline: Pipeline) -> None:
        self.spark, self.root, self.pipeline = spark, root.rstrip("/"), pipeline

    def _exists(self, path: str) -> bool:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).exists(p)

    def has(self, table: str) -> bool:
        return self._exists(f"{self.root}/{table}/_SUCCESS")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{name}")

    def ledger(self) -> dict[str, dict]:
        """The last run of each stage."""
        if not self._exists(f"{self.root}/_ledger"):
            return {}
        rows = self.spark.read.schema(LEDGER).json(f"{self.root}/_ledger").collect()
        return {r.stage: r.asDict() for r in sorted(rows, key=lambda r: r.ran_at)}

    def _record(self, stage: str, fingerprint: str, rows: int) -> None:
        at = datetime.now(timezone.utc).isoformat()
        self.spark.createDataFrame([(stage, fingerprint, rows, at)], LEDGER).coalesce(1).write.mode("append").json(f"{self.root}/_ledger")

    def status(self, targets: list[str] | None = None) -> dict[str, str]:
        """``fresh`` or why a stage would run; the same rule that :meth:`run` follows."""
        ledger, prints, out = self.ledger(), {}, {}
        for name in self.pipeline.plan(targets):
            s = self.pipeline.stages[name]
            mark = self.pipeline.fingerprint(name, prints)
            stale = [n for n in self.pipeline.needs(name) if out[n] != "fresh"]
            if s.always:
                out[name] = "always runs"
            elif name not in ledger:
                out[name] = "never ran"
            elif ledger[name]["fingerprint"] != mark:
                out[name] = "code, settings or inputs changed"
            elif not all(self.has(t) for t in s.writes):
                out[name] = "an output is missing"
            elif stale:
                out[name] = f"after {stale[0]}"
            else:
                out[name] = "fresh"
        return out

    def run(self, targets: list[str] | None = None, force: bool = False) -> list[str]:
        """Run what isn't fresh; returns the stages that ran."""
        ran, state = [], self.status(targets)
        prints: dict[str, str] = {}
        for name in self.pipeline.plan(targets):
            s = self.pipeline.stages[name]
            if state[name] == "fresh" and not force:
                continue
            missing = [t for t in s.reads if not self.has(t)]
            if missing:
                raise BuildError(f"{name} reads {missing[0]}, which isn't there")
            made = s.run(self.spark, {t: self.table(t) for t in s.reads}, {p: self.pipeline.params.get(p) for p in s.params})
            if set(made) != set(s.writes):
                raise BuildError(f"{name} returned {sorted(made)} and declares {sorted(s.writes)}")
            for table, df in made.items():
                df.write.mode("overwrite").parquet(f"{self.root}/{table}")
            self._record(name, self.pipeline.fingerprint(name, prints), sum(self.table(t).count() for t in s.writes))
            ran.append(name)
        return ran


def licence_gate(used: DataFrame, sources: DataFrame) -> None:
    """Refuse to publish from a source that isn't both open and permitted."""
    allowed = sources.where("open and permitted").select("source")
    bad = [r[0] for r in used.select("source").distinct().join(allowed, "source", "left_anti").orderBy("source").limit(20).collect()]
    if bad:
        raise BuildError(f"not licensed for publication: {', '.join(map(str, bad))}")


def calibrated(measured: float, expected: float, tolerance: float = 0.03) -> float:
    """The relative drift from an expected total, or an error where it is beyond the tolerance."""
    drift = (measured - expected) / expected
    if abs(drift) > tolerance:
        raise BuildError(f"{measured:g} is {drift:+.1%} off the expected {expected:g}")
    return drift
