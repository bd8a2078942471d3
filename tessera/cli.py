"""Command line: python -m tessera.cli COMMAND. Exit codes: 0 done, 1 failed, 2 arguments, 3 settings, 4 validation, 5 service."""

from __future__ import annotations

import argparse
import json
import subprocess
import sys
import time

from tessera import logs
from tessera.config import read
from tessera.operators.state import Checkpoints
from tessera.plans import services
from tessera.session import session

DONE, FAILED, ARGUMENTS, CONFIG, INVALID, SERVICE = range(6)
VERTICALS = services.ORDER


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tessera")
    p.add_argument("--json", action="store_true", help="print results as JSON")
    sub = p.add_subparsers(dest="command", required=True)
    for name in ("health", "test", "stats", "validate", "status", "llm-health", "llm-smoke-test"):
        sub.add_parser(name)
    for v in VERTICALS:
        c = sub.add_parser(v)
        _taken(c)
        c.add_argument("--offset", type=int, default=0, help="rows of each source to pass over, where nothing is resumed")
        c.add_argument("--sources", default=None)
        c.add_argument("--dry-run", action="store_true")
    c = sub.add_parser("fetch", help="fetches and lands payloads")
    c.add_argument("vertical", choices=VERTICALS)
    c.add_argument("--limit", type=int, default=50, help="rows, shared by the sources")
    c.add_argument("--offset", type=int, default=0)
    c.add_argument("--sources", default=None)
    c.add_argument("--workers", type=int, default=None, help="requests under way at a time")
    c.add_argument("--resume", action=argparse.BooleanOptionalAction, default=True)
    c = sub.add_parser("pipeline")
    _taken(c)
    c.add_argument("--source", choices=VERTICALS)
    for v in VERTICALS:
        c.add_argument(f"--skip-{v}", action="store_true")
    c = sub.add_parser("reset-checkpoints")
    c.add_argument("--vertical", choices=VERTICALS)
    c = sub.add_parser("resolve")
    c.add_argument("names", nargs="*")
    c = sub.add_parser("export")
    c.add_argument("--vertical")
    c.add_argument("--dry-run", action="store_true")
    c = sub.add_parser("benchmark")
    c.add_argument("--records", type=int, default=100)
    c = sub.add_parser("crawl-test")
    c.add_argument("url", nargs="+")
    c.add_argument("--concurrency", type=int, default=None, help="requests under way at a time")
    return p


def _taken(c: argparse.ArgumentParser) -> None:
    """Options of what a run takes."""
    c.add_argument("--limit", type=int, default=None, help="rows, shared by the sources; without it all that has landed")
    c.add_argument("--batch-size", type=int, default=50, help="files a batch, without a limit")
    c.add_argument("--batch-rows", type=int, default=10_000, help="rows a batch, with a limit")
    c.add_argument("--resume", action=argparse.BooleanOptionalAction, default=True, help="go on where the last run stopped")


def run(args: argparse.Namespace, env: dict[str, str], spark=None) -> tuple[int, object]:
    """(exit code, what to print)."""
    try:
        settings = read(env)
    except ValueError as e:
        return CONFIG, {"error": str(e)}
    cmd = args.command
    if cmd == "test":
        return (DONE if subprocess.run([sys.executable, "-m", "pytest", "tests", "-q"]).returncode == 0 else FAILED), {}
    if cmd == "llm-health":
        return DONE, services.chain(settings).health()
    if cmd == "llm-smoke-test":
        from tessera.providers.models import ProviderError, Request

        try:
            return DONE, {"answer": services.chain(settings).generate(Request("Answer with the word ok.")).text}
        except ProviderError as e:
            return SERVICE, {"error": str(e)}
    spark = spark or session()
    folder = settings.data_folder
    if cmd == "health":
        got = services.health(spark, settings)
        return (DONE if got["spark"] == got["data"] == "ok" else SERVICE), got
    if cmd == "stats":
        return DONE, [r.asDict() for r in services.report(spark, folder).collect()]
    if cmd == "validate":
        got = services.validation(spark, folder)
        return (DONE if got["status"] == "PASS" else INVALID), got
    if cmd in VERTICALS:
        try:
            c = services.ingest(spark, settings.landed_folder, cmd, folder, args.batch_size, args.sources, dry_run=args.dry_run, limit=args.limit, offset=args.offset, resume=args.resume, batch_rows=args.batch_rows)
        except Exception as e:  # noqa: BLE001
            return SERVICE, {"error": str(e)[:300]}
        return DONE, {**vars(c), "requested": args.limit, "a_second": c.a_second}
    if cmd == "fetch":
        got = services.fetch(spark, settings, args.vertical, args.limit, args.sources, args.resume, args.offset, args.workers)
        return (DONE if any(x.status != "failed" for x in got) else SERVICE), [vars(x) for x in got]
    if cmd == "pipeline":
        got = services.pipeline(spark, settings, {v for v in VERTICALS if getattr(args, f"skip_{v}")}, args.source, limit=args.limit, batch_files=args.batch_size, batch_rows=args.batch_rows, resume=args.resume)
        return (SERVICE if any(isinstance(x, dict) and x.get("status") == "failed" for x in got.values()) else DONE), got
    if cmd == "status":
        held = Checkpoints(spark, f"{folder}/checkpoints").all()
        return DONE, [r.asDict() for r in held.collect()] if held is not None else []
    if cmd == "reset-checkpoints":
        return DONE, {"deleted": Checkpoints(spark, f"{folder}/checkpoints").reset(args.vertical)}
    if cmd == "resolve":
        return DONE, services.run_resolution(spark, folder, args.names)
    if cmd == "export":
        try:
            got = services.export(spark, settings, args.vertical, args.dry_run)
        except ValueError as e:
            return ARGUMENTS, {"error": str(e)}
        return (CONFIG if any(r.status == "not_configured" for r in got) else DONE), [vars(r) for r in got]
    if cmd == "benchmark":
        return DONE, services.benchmark(spark, folder, args.records)
    from tessera.sources.crawl import CrawlPolicy, fetch

    policy = CrawlPolicy(args.concurrency or settings.crawler_concurrency, timeout=settings.crawler_timeout, retries=settings.crawler_max_retries, headers={"User-Agent": settings.crawler_user_agent}, token=settings.github_token)
    rows = fetch(spark.createDataFrame(list(enumerate(args.url)), "ord long, url string"), policy).drop("content").orderBy("ord").collect()
    return (DONE if all(r.success for r in rows) else SERVICE), [r.asDict() for r in rows]


def main(argv: list[str] | None = None) -> int:
    import os

    try:
        args = parser().parse_args(argv)
    except SystemExit as e:
        return ARGUMENTS if e.code else DONE
    logs.set_up(os.environ.get("LOG_LEVEL", "INFO"))
    began = time.monotonic()
    code, out = run(args, dict(os.environ))
    logs.event("cli", "command done", command=args.command, code=code, seconds=round(time.monotonic() - began, 3))
    print(json.dumps(out, default=str, indent=None if args.json else 2))
    return code


if __name__ == "__main__":
    sys.exit(main())
