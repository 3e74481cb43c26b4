"""Command line: ``convert`` a dump, ``validate`` what was written, ``summary`` of several outputs."""

from __future__ import annotations

import argparse
import json
import sys

from . import __version__
from .operators.sink import CHUNK_SIZE, convert, summary
from .operators.validate import validate
from .session import session
from .sources import SOURCES


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="tripleloom")
    out.add_argument("--version", action="version", version=__version__)
    commands = out.add_subparsers(dest="command", required=True)
    c = commands.add_parser("convert", help="convert a dump to Turtle, JSON-LD and N-Triples")
    c.add_argument("-s", "--source", choices=list(SOURCES), default="biosample")
    c.add_argument("-i", "--input", required=True)
    c.add_argument("-o", "--output-dir", default="./output")
    c.add_argument("-c", "--chunk-size", type=int, default=CHUNK_SIZE)
    v = commands.add_parser("validate", help="check a .ttl or .nt file, or an output folder")
    v.add_argument("path")
    v.add_argument("-s", "--source", choices=list(SOURCES), default="biosample")
    m = commands.add_parser("summary", help="manifests of several outputs, and their sum")
    m.add_argument("outputs", nargs="+", help="source=folder")
    return out


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    spark = session()
    if args.command == "convert":
        print(json.dumps(convert(spark, args.source, args.input, args.output_dir, args.chunk_size), indent=2))
        return 0
    if args.command == "summary":
        for x in summary(spark, dict(x.split("=", 1) for x in args.outputs)).collect():
            print(*x, sep="\t")
        return 0
    report = validate(spark, args.path, args.source)
    print(f"{report.files} files, {report.records} records, {report.error_count} errors")
    if report.error_count:
        for e in report.errors.orderBy("path", "line").toLocalIterator():
            print(f"{e.path}: line {e.line}: {e.message}")
    return 0 if report.ok else 1


if __name__ == "__main__":
    sys.exit(main())
