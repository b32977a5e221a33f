"""Run the jobs: ``spark-submit … -m loreweave ROOT [--dump PATH] [--books PATH] [flags]``."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from loreweave.operators.embedding import backend
from loreweave.plans.jobs import run
from loreweave.plans.report import run_checks
from loreweave.sources.warehouse import Warehouse


def main(argv: list[str] | None = None) -> dict:
    p = argparse.ArgumentParser(prog="loreweave", description="Sync and embed a knowledge base.")
    p.add_argument("root", help="folder of the tables")
    p.add_argument("--dump", help="record dump to sync (JSON, may be compressed)")
    p.add_argument("--lines", help="entries to sync as JSON lines, instead of a dump")
    p.add_argument("--sidecar", help="file with the dump's SHA-256")
    p.add_argument("--books", help="rule books to embed (text)")
    p.add_argument("--backend", default="hashing")
    p.add_argument("--source", action="append", dest="only", help="embed only this source; repeatable")
    p.add_argument("--init", action="store_true", dest="init_only", help="create the tables only")
    p.add_argument("--etl-only", action="store_true")
    p.add_argument("--embed-only", action="store_true")
    p.add_argument("--full-refresh", action="store_true", help="embed everything again")
    p.add_argument("--report", action="store_true", help="only check the tables; the exit code is 1 if a check fails")
    a = vars(p.parse_args(argv))
    if not (a["init_only"] or a["embed_only"] or a["report"]) and not (a["dump"] or a["lines"]):
        p.error("--dump or --lines is needed unless --init, --embed-only or --report is given")
    spark = SparkSession.builder.appName("loreweave").getOrCreate()
    model = backend(a.pop("backend"))
    if a.pop("report"):
        verdicts = {r.name: r.verdict for r in run_checks(Warehouse(spark, a["root"]), model).collect()}
        for name, verdict in verdicts.items():
            print(f"{verdict:5} {name}")
        if any(v.upper() == "FAIL" for v in verdicts.values()):
            sys.exit(1)
        return verdicts
    done = run(spark, a.pop("root"), model=model, **a)
    for stage, counts in done.items():
        print(stage, counts)
    return done


if __name__ == "__main__":
    main()
