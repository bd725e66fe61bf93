"""Command line: extract, compare and run publish a corpus, verify only checks its sources."""

from __future__ import annotations

import argparse
import sys

from .errors import CorpusError, InvalidExtraction


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="paperlode")
    p.add_argument("--repo-root", default=".")
    sub = p.add_subparsers(dest="command", required=True)
    for name in ("extract", "compare", "run", "verify"):
        sub.add_parser(name).add_argument("--config", required=True)
    return p


def finish(report: dict) -> None:
    print(
        f"published {len(report['sources'])} sources and {len(report['comparisons'])} cadre reports; {report['blocking_issues']} blocking issues; "
        f"semantic digest {report['semantic_artifact_sha256']}"
    )
    if report["blocking_issues"]:
        raise InvalidExtraction(f"report contains {report['blocking_issues']} blocking validation issues")


def main(argv: list[str] | None = None, engine=None) -> int:
    """The exit status: 0, or 1 for an error or blocking issues; wrong usage exits with 2."""
    args = parser().parse_args(argv)
    try:
        if engine is None:
            from pyspark.sql import SparkSession

            from .plans.corpus import Engine

            engine = Engine(SparkSession.builder.appName("paperlode").getOrCreate(), args.repo_root)
        if args.command == "verify":
            report = engine.verify(args.config)
            print(f"verified {len(report['sources'])} sources with Poppler {report['poppler_version']}")
        else:
            finish(engine.run(args.config))
    except CorpusError as e:
        print(f"error: {e}", file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
