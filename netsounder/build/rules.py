"""A list of rules that the build is held to: ordered, in a declared vocabulary, each reference resolved."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from netsounder.build.pipeline import BuildError, Params

_NEEDED = ("id", "order", "kind", "status", "title", "statement")
_REFERENCE = re.compile(r"\bR-\d+\b")


@dataclass(frozen=True)
class Rule:
    id: str
    order: int
    kind: str
    status: str
    title: str
    statement: str
    owner: str = ""
    stage: str = ""
    implements: tuple[str, ...] = ()
    params: tuple[str, ...] = ()
    supersedes: tuple[str, ...] = ()
    superseded_by: str = ""
    evidence: tuple[str, ...] = field(default=())


class Rules:
    """Rules from plain dictionaries; whatever is wrong with the list is found when it is read, all of it at once."""

    def __init__(self, entries: list[dict], statuses: set[str], kinds: set[str], params: Params | None = None) -> None:
        wrong = [f"{e.get('id', 'a rule')} has no {k}" for e in entries for k in _NEEDED if e.get(k) in (None, "")]
        if wrong:
            raise BuildError("; ".join(wrong))
        self.rules = [Rule(**{k: tuple(v) if isinstance(v, list) else v for k, v in e.items()}) for e in entries]
        self.rules.sort(key=lambda r: r.order)
        names = {r.id for r in self.rules}
        if len(names) < len(self.rules):
            wrong.append("an id stands twice")
        if [r.order for r in self.rules] != list(range(1, len(self.rules) + 1)):
            wrong.append(f"order is not 1 to {len(self.rules)}")
        for r in self.rules:
            if r.status not in statuses:
                wrong.append(f"{r.id}: status {r.status} is not declared")
            if r.kind not in kinds:
                wrong.append(f"{r.id}: kind {r.kind} is not declared")
            if r.status == "implemented" and not r.implements:
                wrong.append(f"{r.id} is implemented by nothing")
            if r.status == "superseded" and not r.superseded_by:
                wrong.append(f"{r.id} has no successor")
            for other in {*r.supersedes, *filter(None, [r.superseded_by]), *_REFERENCE.findall(f"{r.title} {r.statement}")}:
                if other == r.id:
                    wrong.append(f"{r.id} refers to itself")
                elif other not in names:
                    wrong.append(f"{r.id} refers to {other}, which is no rule")
            for path in r.params if r.status == "implemented" and params else ():
                try:
                    params.get(path)
                except BuildError as e:
                    wrong.append(f"{r.id}: {e}")
        if wrong:
            raise BuildError("; ".join(wrong))

    def listed(self, status: str | None = None, owner: str | None = None) -> list[Rule]:
        """Rules in order, of one status or owner where given."""
        return [r for r in self.rules if status in (None, r.status) and owner in (None, r.owner)]
