"""Command line: ``python -m evigrid COMMAND``; every command prints one JSON envelope."""

from __future__ import annotations

import argparse
import itertools
import json
import sys
import time
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import schemas
from .functions.text import normalize_domain
from .operators.graph import cut
from .plans import query, runs, settings, stages
from .sources import files, seeds, sinks, store
from .streaming import controls, tail

#: Exit codes: done, failed, refused.
DONE, FAILED, REFUSED = 0, 1, 2
#: Runs of a tail that its report names.
_KEPT_RUNS = 20


def make_parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="evigrid", description="Evidence-first record intelligence on Spark")
    parser.add_argument("--store", default="store", help="folder of tables and runs, on any file system")
    parser.add_argument("--tenant", default="default")
    commands = parser.add_subparsers(dest="command", required=True)
    for name, text in (("sync", "extract, resolve, score, decide and export landed pages"), ("tail", "the same for pages that land later, under the controls of the time")):
        sync = commands.add_parser(name, help=text)
        sync.add_argument("--pages", required=True, help="Parquet of landed pages: url, html, status_code, seed_website")
        sync.add_argument("--seeds", required=True, help="seed pack, JSON or CSV")
        sync.add_argument("--rules", required=True, help="rule pack, JSON")
        sync.add_argument("--run-id", required=True)
        sync.add_argument("--limit", type=int, default=100)
    sync.add_argument("--interval", type=int, default=tail.TAIL_SECONDS, help="seconds between looks, at least 1")
    sync.add_argument("--iterations", type=int, default=0, help="looks until the end; 0 for no end")
    preset = commands.add_parser("preset", help="one of the set queries over the tables")
    preset.add_argument("name", choices=sorted(query.PRESETS))
    preset.add_argument("--limit", type=int, default=20)
    search = commands.add_parser("search", help="find records by a part of their names")
    search.add_argument("text")
    search.add_argument("--limit", type=int, default=20)
    sql = commands.add_parser("sql", help="run a read-only statement over the tables")
    sql.add_argument("statement")
    sql.add_argument("--limit", type=int, default=200)
    control = commands.add_parser("control", help="quarantine, suppress, cap, stop or clear a domain")
    control.add_argument("action", choices=[*runs.ACTIONS, "show"])
    control.add_argument("domain", nargs="?", default="")
    control.add_argument("--reason", default="operator")
    control.add_argument("--prefix", default="")
    control.add_argument("--max-pages", type=int, default=0)
    for name, text in (("status", "state of the latest run"), ("doctor", "check the store and its settings"), ("init", "make the store's tables")):
        commands.add_parser(name, help=text)
    return parser


_TABLES = ("decided", "field_evidence", "contradictions", "review_queue", "providers", "practices", "practice_locations", "licenses")


def _sync(spark: SparkSession, args: argparse.Namespace, landed: DataFrame | None = None, run_id: str = "") -> dict:
    run_id = run_id or args.run_id
    run = runs.Run(files.join(args.store, "runs"), run_id, args.tenant, ("extract", "merge", "export"))
    kept = store.KeyedTable(spark, files.join(args.store, "extracted"), ["extracted_id"])

    def extract(spark, run):
        pages = seeds.with_seed(spark.read.parquet(args.pages) if landed is None else landed, seeds.ordered(seeds.dedupe(seeds.coerce(seeds.read_rows(spark, args.seeds)))))
        return stages.extract_pages(pages, F.current_timestamp())

    def merge(spark, run):
        # rows of earlier runs stay, so that records are resolved over all of them
        done = kept.upsert(run.table(spark, "extract"), F.col("created_at"))
        return spark.createDataFrame([(done["version"], len(done["rewritten"]))], "version long, rewritten long")

    def export(spark, run):
        tables = stages.score_and_decide(stages.resolve_records(kept.read(run.table(spark, "merge").first()["version"])), seeds.read_rules(spark, args.rules))
        for name in _TABLES:
            tables[name].write.mode("overwrite").parquet(files.join(args.store, "tables", name))
        written = sinks.write_exports(stages.export_accounts(tables, args.limit), files.join(args.store, "out"), run_id)
        return spark.createDataFrame([(json.dumps(written), json.dumps(tables["stats"].first().asDict()))], "files string, stats string")

    noted = runs.Controls(files.join(args.store, "controls.json"))
    try:
        state = run.execute(spark, {"extract": extract, "merge": merge, "export": export})
    except Exception as error:
        noted.finalise("failed", message=str(error))
        raise
    noted.finalise(state["status"])
    row = run.table(spark, "export").first()
    return {"run_id": run_id, "status": state["status"], "report": json.loads(row["files"]), "summary": json.loads(row["stats"])}


def _tail(spark: SparkSession, args: argparse.Namespace) -> dict:
    """Runs over what lands, one a micro-batch, named by its number; a run that was broken off goes on when its micro-batch is repeated."""
    done: list[dict] = []
    counted = store.KeyedTable(spark, files.join(args.store, "tail", args.run_id, "admitted"), ["domain", "batch"], 16)

    def batch(pages: DataFrame, n: int) -> None:
        held = runs.Controls(files.join(args.store, "controls.json")).frame(spark)
        before = counted.read().where(F.col("batch") < n).groupBy("domain").agg(F.sum("pages").alias("pages")) if counted.versions() else None
        kept = cut(controls.admitted(pages, held, landed=before))
        counted.upsert(kept.groupBy(normalize_domain(F.col("url")).alias("domain")).agg(F.count("*").alias("pages")).withColumn("batch", F.lit(n).cast("long")))
        done.append(_sync(spark, args, kept, f"{args.run_id}-{n:06d}"))

    for look in itertools.count(1):
        schema = spark.read.parquet(args.pages).schema
        tail.tail(tail.landed_stream(spark, args.pages, schema), batch, files.join(args.store, "tail", args.run_id, "stream"), once=True).awaitTermination()
        if look == args.iterations:
            return {"run_id": args.run_id, "looks": look, "runs": done}
        del done[:-_KEPT_RUNS]
        time.sleep(max(1, args.interval))


def _views(spark: SparkSession, store: str) -> None:
    for name in _TABLES:
        path = files.join(store, "tables", name)
        if files.exists(path):
            spark.read.parquet(path).createOrReplaceTempView(name)
            if name == "decided":
                spark.table(name).createOrReplaceTempView("provider_practice_records")
    if files.exists(files.join(store, "tables", "contradictions")):
        # a contradiction is as old as the decision that found it
        decided = spark.table("decided").select("record_id", F.col("updated_at").alias("created_at"))
        spark.read.parquet(files.join(store, "tables", "contradictions")).join(decided, "record_id").createOrReplaceTempView("contradictions")
    path = files.join(store, "schema", "seed_telemetry")
    (spark.read.parquet(path) if files.exists(path) else schemas.empty(spark, "seed_telemetry")).createOrReplaceTempView("seed_telemetry")


def execute(spark: SparkSession, args: argparse.Namespace) -> object:
    """The result of a command."""
    if args.command == "sync":
        return _sync(spark, args)
    if args.command == "tail":
        return _tail(spark, args)
    if args.command == "init":
        return {"made": schemas.migrate(spark, files.join(args.store, "schema")), "fingerprint": schemas.fingerprint()}
    if args.command == "doctor":
        missing = [n for n in schemas.TABLES if not files.exists(files.join(args.store, "schema", n))]
        drifted = {n: d for n in schemas.TABLES if n not in missing and (d := schemas.drift(spark.read.parquet(files.join(args.store, "schema", n)), n))}
        return {"ok": not missing and not drifted, "missing": missing, "drift": drifted, "fingerprint": schemas.fingerprint()}
    if args.command == "status":
        folder = files.join(args.store, "runs", runs.tenant_id(args.tenant))
        newest = files.latest(folder, "latest.json") or ""
        return json.loads(files.read_bytes(newest)) if newest else {"status": "none"}
    if args.command == "control":
        kept = runs.Controls(files.join(args.store, "controls.json"))
        if args.action != "show":
            runs.check_tool("control_apply", {"reason": args.reason, "action": args.action, "domain": args.domain, "prefix": args.prefix, "max_pages": args.max_pages})
            kept.apply(args.action, args.domain, args.reason, prefix=args.prefix, max_pages=args.max_pages)
        return kept.summary()
    _views(spark, args.store)
    if args.command == "sql":
        found = query.run_sql(spark, args.statement, args.limit)
    elif args.command == "preset":
        found = query.preset(spark, args.name, args.limit)
    else:
        found = query.search(spark.table("decided"), ["provider_name_snapshot", "practice_name_snapshot"], args.text, ["record_id"], args.limit)
    return [json.loads(r) for r in found.toJSON().collect()]


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> int:
    args = make_parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName("evigrid").getOrCreate()
    try:
        result = execute(spark, args)
        if args.command == "sync":
            files.write_bytes(files.join(args.store, "runs", runs.tenant_id(args.tenant), "latest.json"), json.dumps(result).encode())
        print(runs.report(args.command, result))
        return DONE
    except (runs.PolicyError, query.RefusedQuery) as error:
        print(runs.report(args.command, {"code": "refused", "message": str(error)}, ok=False))
        return REFUSED
    except Exception as error:
        print(runs.report(args.command, {"code": type(error).__name__, "message": str(error)[:500]}, ok=False))
        return FAILED


if __name__ == "__main__":
    sys.exit(main())
