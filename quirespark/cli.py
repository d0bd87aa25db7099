"""``python -m quirespark.cli list-stages | run FOLDER STORE [--only ...] [--from ...] [--to ...] [--pages ...] [--dry-run]``."""

from __future__ import annotations

import argparse
import json
import os

from . import storage
from .plans.stages import MODES, Runner, document_stages, package, with_optional
from .sources.files import keep_pages, parse_pages
from .sources.tables import table, version


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="quirespark")
    sub = parser.add_subparsers(dest="command", required=True)
    sub.add_parser("list-stages")
    run = sub.add_parser("run")
    run.add_argument("folder")
    run.add_argument("store")
    run.add_argument("--from", dest="first")
    run.add_argument("--to", dest="last")
    run.add_argument("--only", nargs="*")
    run.add_argument("--exclude", nargs="*")
    run.add_argument("--pages")
    run.add_argument("--memory", help="folder of the translation memory, read and added to")
    run.add_argument("--release", help="folder for the bundle and the archives of accepted documents")
    run.add_argument("--cache", choices=MODES, default="read_write")
    run.add_argument("--dry-run", action="store_true", help="cost estimate only")
    args = parser.parse_args(argv)
    stages = document_stages()
    if args.command == "list-stages":
        for name, stage in stages.stages.items():
            print(name, stage.version, *stage.needs)
        return 0

    from .operators.translation import estimate, unit_sizes
    from .session import local_session

    spark = local_session()
    if args.dry_run:
        estimate(unit_sizes(table(spark, args.folder, "translation_units"))).orderBy("doc_id").show(truncate=False)
        return 0
    texts = keep_pages(table(spark, args.folder, "text_primitives"), parse_pages(args.pages) if args.pages else None)
    runner = Runner(spark, args.store, args.cache)
    inputs = {"texts": texts, "terms": table(spark, args.folder, "glossary_terms"), "titles": table(spark, args.folder, "doc_summaries").select("doc_id", "title_en", "title_ru")}
    read = {"texts": "text_primitives", "terms": "glossary_terms", "titles": "doc_summaries"}
    versions = {name: f"{v}:{args.pages}" for name, source in read.items() if (v := version(spark, args.folder, source))}
    memory = os.path.join(args.memory, "memory") if args.memory else None
    if memory and storage.exists(spark, os.path.join(memory, "_SUCCESS")):
        inputs["memory"], versions["memory"] = spark.read.parquet(memory), str(storage.version(spark, memory))
    tables = runner.run(stages.select(args.first, args.last, args.only, args.exclude), *with_optional(spark, inputs, versions))
    if memory and "memory_new" in tables:
        # The stage's result lies in the store or in a checkpoint: it does not read what is appended to.
        fresh = tables["memory_new"]
        if not fresh.isEmpty():
            fresh.write.mode("append").parquet(memory)
    if args.release and {"bundle", "releases"} <= set(tables):
        for manifest in package(tables, args.release):
            print(json.dumps(manifest, sort_keys=True, default=str))
    runner.stage_runs().select("stage", "status", "cache", "duration_ms").show(50, truncate=False)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
