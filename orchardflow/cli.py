"""Command line: ``scrape`` runs a config, ``validate`` prints its plan and fetches nothing.

Exit codes: 0 for a clean run, 1 for an incomplete one, 2 for a config that cannot run.
"""

from __future__ import annotations

import argparse
import json
import logging
import sys
from datetime import UTC, datetime

from orchardflow.sources.config import Config, ConfigError, load_config


class JsonLines(logging.Formatter):
    def format(self, record: logging.LogRecord) -> str:
        return json.dumps({"at": datetime.fromtimestamp(record.created, UTC).isoformat(), "level": record.levelname, "event": record.getMessage(), **getattr(record, "data", {})}, default=str)


def log_to(stream, level: str, form: str) -> logging.Logger:
    log = logging.getLogger("orchardflow")
    handler = logging.StreamHandler(stream)
    handler.setFormatter(JsonLines() if form == "json" else logging.Formatter("%(levelname)s %(message)s"))
    log.handlers[:] = [handler]
    log.setLevel(level)
    return log


def pinned(text: str) -> datetime:
    found = datetime.fromisoformat(text)
    if found.tzinfo is None:
        raise argparse.ArgumentTypeError("--now needs a time zone")
    return found


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="orchardflow", description=__doc__)
    commands = top.add_subparsers(dest="command", required=True)
    for name in ("scrape", "validate"):
        c = commands.add_parser(name)
        c.add_argument("--config", required=True)
        c.add_argument("--source", action="append", default=[], help="run this source only; may be repeated")
        if name == "scrape":
            c.add_argument("--events", help="folder for a JSON line for each page and each record that was not exported, written by the executors")
            c.add_argument("--crawl-store", help="shared folder of fetched pages; a run that broke off goes on from it, failures are tried again")
            c.add_argument("--pages", help="Parquet of fetched pages; without it they are crawled")
            c.add_argument("--only-changed", action="store_true")
            c.add_argument("--output-dir")
            c.add_argument("--tables", action="store_true", help="write folders of part files from the executors instead of single files")
            c.add_argument("--now", type=pinned)
    return top


def summary(report: dict) -> str:
    lines = [f"run {report['run_id']}: {report['exported']} exported, exit {report['exit_code']}"]
    lines += [f"  {s['source_id']}: {s['records_found']} found, {s['valid']} valid, {s['rejected']} rejected, stopped: {s['stopped_because']}" for s in report["sources"]]
    lines += [f"  rejected {k}: {n}" for k, n in sorted(report["rejections_by_reason"].items())]
    lines += [f"  {k}: {n}" for k, n in sorted(report["changes"].items()) if n]
    lines += [f"  warning: {w}" for w in report["warnings"][:10]]
    return "\n".join(lines)


def described(config: Config) -> str:
    lines = [f"{config.path} (sha256 {config.sha256[:12]})", f"output: {config.run.output_dir} as {', '.join(config.run.formats)}", f"key: {', '.join(config.dedupe.key_fields)}, {config.dedupe.on_conflict}"]
    for s in config.sources:
        lines.append(f"{s.id}: {s.kind} {s.start_url}, {s.pagination.strategy}, records {s.record_selector}")
        lines += [f"  {k}: {m.selector}" + (f" @{m.attr}" if m.attr else "") for k, m in s.fields.items()]
    return "\n".join(lines)


def main(args: list[str] | None = None) -> int:
    asked = parser().parse_args(args)
    try:
        config = load_config(asked.config)
        if asked.source:
            config = config.only(asked.source)
        if asked.command == "scrape" and asked.only_changed and not config.run.state_file:
            raise ConfigError("--only-changed needs run.state_file")
        if asked.command == "validate":
            print(described(config))
            return 0
        return _scrape(asked, config)
    except ConfigError as wrong:
        print(f"config error: {wrong}", file=sys.stderr)
        return 2


def _scrape(asked: argparse.Namespace, config: Config) -> int:
    from pyspark.sql import SparkSession

    from orchardflow.operators.changes import merged_state
    from orchardflow.plans.run import run
    from orchardflow.sources.crawl import crawl, rendered_pages
    from orchardflow.sources.shared import discard, fresh, remove, stored
    from orchardflow.sources.sinks import write_events, write_files, write_report, write_tables
    from orchardflow.sources.state import read_state, write_state

    log = log_to(sys.stderr, config.run.log_level, config.run.log_format)
    spark = SparkSession.builder.appName("orchardflow").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    state = read_state(spark, config.run.state_file)
    # fetched pages are kept one by one as they come, and written as a table before anything reads them: whatever is lost, none is fetched twice
    kept = asked.crawl_store or fresh(spark, "crawl")
    pages = rendered_pages(spark, asked.pages) if asked.pages else stored(crawl(spark, config, kept, again=bool(asked.crawl_store)), "pages")
    now = asked.now or datetime.now(UTC)
    for s in config.sources:
        log.info("source started", extra={"data": {"source_id": s.id, "kind": s.kind, "start_url": s.start_url}})
    result = run(spark, config, pages, now, state, asked.only_changed)
    folder = asked.output_dir or config.run.output_dir
    if asked.tables:
        write_tables(result, folder, config.run.formats)
        write_report(result.report, folder, {})
    else:
        write_files(result, folder, config.run.formats, config.run.csv_encoding)
    if asked.events:
        write_events(pages, result, asked.events, now)
    if config.run.state_file:
        if result.report["totals"]["valid"]:
            write_state(spark, config.run.state_file, merged_state(result.state, state, [s.id for s in config.sources] if asked.source else None), now)
        else:
            log.warning("the run produced no products; the snapshot stays as it was")
    for s in result.report["sources"]:
        log.info("pagination stopped", extra={"data": {"source_id": s["source_id"], "reason": s["stopped_because"], "pages": s["pages_fetched"], "failed": s["pages_failed"]}})
        if s["stopped_because"] == "max_pages":
            log.warning("page cap reached", extra={"data": {"source_id": s["source_id"]}})
    for reason, n in result.report["rejections_by_reason"].items():
        log.info("records rejected", extra={"data": {"reason": reason, "n": n}})
    log.info("run finished", extra={"data": result.report["totals"]})
    print(summary(result.report))
    result.release()
    if not asked.pages:
        discard(pages)
        if not asked.crawl_store:
            remove(spark, kept)
    return result.report["exit_code"]
