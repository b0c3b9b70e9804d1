"""python -m quillgraph.cli COMMAND: each prints one JSON object; errors go to stderr with exit code 1."""

from __future__ import annotations

import argparse
import json
import os
import sys

from pyspark.sql import SparkSession

from .operators import gates, taxonomy
from .operators.project import Project, _load, find_root, write_json


def run(args: argparse.Namespace, spark: SparkSession) -> tuple[dict, int]:
    if args.command == "init":
        p = Project.init(spark, args.directory, args.title, args.source, args.profile, args.recordings)
        return {"project": p.root}, 0
    p = Project(spark, find_root(os.getcwd()))
    if args.command == "ingest":
        sources, segments = p.ingest()
        return {"sources": sources.count(), "segments": segments.count()}, 0
    if args.command == "pilot":
        return p.pilot(args.response), 0
    if args.command == "onboard":
        pilot = _load(p.path(".quillgraph", "review", "taxonomy-pilot.json"))
        decisions = _load(p.path(args.decisions or ".quillgraph/review/taxonomy-decisions.yml"))
        write_json(p.path("taxonomy.yml"), taxonomy.onboard(p.taxonomy, pilot, decisions, args.accept_recommended).value())
        return {"taxonomyHash": p.lock()["taxonomyHash"]}, 0
    if args.command == "lock":
        return {"taxonomyHash": p.lock()["taxonomyHash"]}, 0
    if args.command == "extract":
        return {"extractions": p.extract(args.responses).count()}, 0
    if args.command == "prepare":
        return p.prepare(args.stage), 0
    if args.command == "normalize":
        g = p.normalize()
        return {name: getattr(g, name).count() for name in g.__dataclass_fields__}, 0
    if args.command == "render":
        files, value = p.render()
        return {"files": files, "hash": value}, 0
    report = p.build() if args.command == "build" else p.verify()
    good = gates.passes(report)
    return {"passed": good, "gates": report.count()}, int(not good)


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="quillgraph")
    commands = parser.add_subparsers(dest="command", required=True)
    init = commands.add_parser("init")
    init.add_argument("directory", nargs="?", default=".")
    init.add_argument("--title", required=True)
    init.add_argument("--source", default="sources/story.md")
    init.add_argument("--profile", choices=taxonomy.PROFILES, default="novel")
    init.add_argument("--recordings")
    commands.add_parser("pilot").add_argument("--response")
    onboard = commands.add_parser("onboard")
    onboard.add_argument("--decisions")
    onboard.add_argument("--accept-recommended", action="store_true")
    commands.add_parser("extract").add_argument("--responses")
    commands.add_parser("prepare").add_argument("stage", choices=("pilot", "extraction"))
    for name in ("ingest", "lock", "normalize", "render", "verify", "build"):
        commands.add_parser(name)
    args = parser.parse_args(argv)
    try:
        value, code = run(args, SparkSession.builder.getOrCreate())
    except Exception as error:
        print(str(error), file=sys.stderr)
        return 1
    print(json.dumps(value))
    return code


if __name__ == "__main__":
    sys.exit(main())
