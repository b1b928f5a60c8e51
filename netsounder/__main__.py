"""Command line: ``python -m netsounder plan|status|run|queries|query ...``."""

from __future__ import annotations

import argparse

from netsounder.build.audit import audit_pipeline
from netsounder.build.pipeline import Build
from netsounder.plans import registry
from netsounder.session import local_session


def main(args: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="netsounder")
    sub = parser.add_subparsers(dest="command", required=True)
    sub.add_parser("queries", help="names of all queries")
    one = sub.add_parser("query", help="run one query over a folder of tables")
    one.add_argument("name")
    one.add_argument("data")
    one.add_argument("--rows", type=int, default=20)
    for name in ("plan", "status", "run"):
        cmd = sub.add_parser(name, help=f"{name} the audit's stages")
        cmd.add_argument("root", nargs="?" if name == "plan" else None)
        cmd.add_argument("--stage", action="append")
        if name == "run":
            cmd.add_argument("--force", action="store_true")
    given = parser.parse_args(args)
    if given.command == "queries":
        print("\n".join(registry.queries()))
        return 0
    if given.command == "plan":
        print("\n".join(audit_pipeline().plan(given.stage)))
        return 0
    spark = local_session()
    if given.command == "query":
        registry.queries()[given.name](spark, given.data).show(given.rows, truncate=False)
        return 0
    build = Build(spark, given.root, audit_pipeline())
    if given.command == "status":
        for name, why in build.status(given.stage).items():
            print(f"{name}: {why}")
    else:
        print("\n".join(build.run(given.stage, given.force)) or "nothing to do")
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
