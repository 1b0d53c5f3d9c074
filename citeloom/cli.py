"""Command line: the stages of the citation pipeline over folders.

    python -m citeloom.cli tei|ocr [venue [year ...]] --client MODULE:FUNCTION [--fallback LIST] --root DIR
    python -m citeloom.cli contexts --grobid|--nougat|--marker [venue [year ...]] --root DIR --out DIR
    python -m citeloom.cli corpus|resolve|labels|split --root DIR --out DIR [--limit N]
    python -m citeloom.cli prompts [venue [year ...]] --root DIR --out DIR

``--root`` may stand in the environment as ROOT_DIR.
"""

from __future__ import annotations

import argparse
import os
import sys

from pyspark.sql import functions as F

from citeloom import chain, schema
from citeloom.chain import run_contexts  # noqa: F401
from citeloom.session import session

COMMANDS = ("tei", "ocr", "contexts", "corpus", "resolve", "labels", "split", "prompts")


def venues(conf: str | None) -> list[str]:
    """The venue that is named, in any case; all without a name."""
    if conf is None:
        return list(schema.VENUES)
    if conf.lower() not in schema.VENUES:
        raise ValueError(f"unknown venue {conf}")
    return [conf.lower()]


def years_of(words: list[str]) -> list[int]:
    """Whole numbers; others are reported and left out."""
    for w in words:
        if not w.isdigit():
            print(f"not a year: {w}", file=sys.stderr)
    return [int(w) for w in words if w.isdigit()]


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="citeloom", description="Citation analytics on Spark")
    parser.add_argument("command", choices=COMMANDS)
    for name in chain.SOURCES:
        parser.add_argument(f"--{name}", dest="source", action="store_const", const=name)
    parser.add_argument("words", nargs="*", help="venue and years")
    parser.add_argument("--root", default=os.environ.get("ROOT_DIR"))
    parser.add_argument("--out")
    parser.add_argument("--client", help="what makes a client of a TEI service or an OCR model")
    parser.add_argument("--fallback", help="a file with a PDF path a line: only these")
    parser.add_argument("--limit", type=int, help="rows of the corpus to label, for trials")
    parser.add_argument("--exclude-appendix", action="store_true")
    parser.add_argument("--retry-errors", action="store_true")
    args = parser.parse_args(argv)
    lacks = {"contexts": args.source is None, "tei": not args.client, "ocr": not args.client}.get(args.command, False)
    if lacks or not args.root or not (args.out or args.command in chain.PDF_STAGES):
        parser.print_usage(sys.stderr)
        return 1
    try:
        confs = venues(args.words[0] if args.words else None)
    except ValueError as e:
        print(e, file=sys.stderr)
        return 1
    spark, years = session(), years_of(args.words[1:])
    if args.command == "split":
        chain.run_split(spark, args.out)
    elif args.command in ("corpus", "resolve"):
        found = {"corpus": chain.run_corpus, "resolve": chain.run_resolve}[args.command](spark, args.root, args.out)
        found.show() if args.command == "resolve" else print(f"{found.count()} papers")
    elif args.command == "labels":
        print(f"{chain.run_labels(spark, args.root, args.out, args.limit).count()} labels are missing")
    else:
        for conf in confs:
            if args.command == "contexts":
                chain.run_contexts(spark, args.source, conf, years, args.root, args.out, args.exclude_appendix, args.retry_errors).show()
            elif args.command == "prompts":
                chain.run_prompts(spark, conf, args.root, args.out).agg(F.sum("total").alias("references"), F.sum("generated").alias("generated"), F.sum("empty").alias("empty")).show()
            else:
                wanted = spark.read.text(args.fallback).select(F.trim("value").alias("path")) if args.fallback else None
                done = chain.run_pdfs(spark, args.command, conf, years, args.root, chain.client_of(args.client), wanted)
                done.groupBy("status").count().show()
    return 0


if __name__ == "__main__":
    sys.exit(main())
