"""Command line for the three jobs, the counterpart of the reference's job scripts.

    python -m fiscalflow.cli ingest  --xml-dir s3a://b/xmls --log s3a://b/nfe-log
    python -m fiscalflow.cli persist --log s3a://b/nfe-log --db nfe_db [--dedup none]
    python -m fiscalflow.cli persist-incremental --log ... --tables s3a://b/nfe-tables
    python -m fiscalflow.cli reports --db nfe_db
    python -m fiscalflow.cli all --xml-dir ... --log ... --db nfe_db

On a cluster, submit a one-line launcher (``from fiscalflow.cli import main; main()``)
with the package on ``--py-files``.  ``--kafka host:port,...`` uses a Kafka topic instead
of the file log.  The session comes from the submitter (master, resources,
``spark.checkpoint.dir``); nothing is set here except the runtime SQL settings of
``fiscalflow.session.configure``.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

from .constants import DEFAULT_TOPIC
from .plans import pipeline
from .session import configure
from .sources.messages import FileLog, KafkaLog


def _log(args):
    if args.kafka:
        return KafkaLog(args.kafka, args.topic)
    if not args.log:
        sys.exit("--log (file message log folder) or --kafka is required")
    return FileLog(args.log, args.topic)


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="fiscalflow")
    ap.add_argument("job", choices=["ingest", "persist", "persist-incremental", "reports", "all"])
    ap.add_argument("--xml-dir")
    ap.add_argument("--glob", default="*.xml")
    ap.add_argument("--many-per-file", action="store_true", help="files hold a batch of nfeProc documents")
    ap.add_argument("--log", help="file message log folder")
    ap.add_argument("--kafka", help="Kafka bootstrap servers (instead of --log)")
    ap.add_argument("--topic", default=DEFAULT_TOPIC)
    ap.add_argument("--db", default="nfe_db")
    ap.add_argument("--dedup", choices=["latest", "none"], default="latest")
    ap.add_argument("--tables", help="folder of the incrementally appended tables")
    ap.add_argument("--cluster", action="store_true", help="apply the shared-cluster AQE profile")
    args = ap.parse_args(argv)

    spark = SparkSession.builder.appName(f"fiscalflow-{args.job}").getOrCreate()
    configure(spark, cluster=args.cluster)
    out: dict = {"job": args.job}
    if args.job in ("ingest", "all"):
        if not args.xml_dir:
            sys.exit("--xml-dir is required")
        res = pipeline.run_ingest(spark, args.xml_dir, _log(args), args.glob, many_per_file=args.many_per_file, db=args.db)
        out["ingest"] = {"batch": res.batch, "messages": res.messages, "rejects": res.rejects.count(), "audit": res.audit.rows()}
    if args.job in ("persist", "all"):
        res = pipeline.run_persist(spark, _log(args), db=args.db, dedup=args.dedup)
        out["persist"] = {"notas": res.notas, "itens": res.itens, "rejects": res.rejects.count()}
    if args.job == "persist-incremental":
        from .streaming.incremental import persist_available

        if not args.tables:
            sys.exit("--tables is required")
        log = _log(args)
        if not isinstance(log, FileLog):
            sys.exit("persist-incremental reads a file message log")
        persist_available(spark, log, args.tables)
        out["tables"] = args.tables
    if args.job in ("reports", "all"):
        out["reports"] = {r.table_name: r.row_count for r in pipeline.run_reports(spark, args.db).collect()}
    print(json.dumps(out, default=str))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
