"""Command line: run the terminal pipeline.

    python -m berthline batch  --bronze PATH --out ROOT [--format parquet|json]
    python -m berthline stream --out ROOT --kafka-option kafka.bootstrap.servers=HOST:9092 \
                               [--kafka-option KEY=VALUE ...] [--trigger "1 minute"]
    python -m berthline demo   --sf-dir /root/testdata/sf0.001 --out ROOT

batch:  Kafka-shaped rows (key, value, topic, partition, offset, timestamp,
        timestampType) of the three topics from files -> every table under ROOT.
stream: the same as long-running queries over Kafka (one checkpoint per table), with the
        bronze tables in between; --database names the tables in the catalog.
publish: after or between streaming runs, write the gold tables clustered and the
        daily summary as new versions.
land-schedule: manifests (JSON documents) -> dated schedule landing, one folder a day.
demo:   bronze derived from the driver's tables (stand-in adapter), then batch.
"""

from __future__ import annotations

import argparse
import json
import time

from . import schemas
from .plans import pipeline
from .session import build_session
from .sources import bronze, sinks


def _batch(spark, crane, gate_in, gate_out, out: str) -> dict:
    p = pipeline.TerminalPipeline(crane, gate_in, gate_out)
    return pipeline.materialize(p, out)


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="berthline")
    sub = ap.add_subparsers(dest="cmd", required=True)
    b = sub.add_parser("batch")
    b.add_argument("--bronze", required=True)
    b.add_argument("--format", default="parquet")
    b.add_argument("--out", required=True)
    s = sub.add_parser("stream")
    s.add_argument("--out", required=True)
    s.add_argument("--kafka-option", action="append", default=[])
    s.add_argument("--trigger", default="1 minute")
    s.add_argument("--database", default=None)
    s.add_argument("--state-partitions", type=int, default=None)
    s.add_argument("--salts", type=int, default=1)
    u = sub.add_parser("publish")
    u.add_argument("--out", required=True)
    u.add_argument("--database", default=None)
    v = sub.add_parser("land-schedule")
    v.add_argument("--manifests", required=True, action="append")
    v.add_argument("--out", required=True)
    d = sub.add_parser("demo")
    d.add_argument("--sf-dir", required=True)
    d.add_argument("--out", required=True)
    for x in (b, s, u, v, d):
        x.add_argument("--master", default=None)
    a = ap.parse_args(argv)

    spark = build_session(master=a.master)
    if a.cmd == "batch":
        read = lambda t: bronze.read_bronze(spark, t, fmt=a.format, path=a.bronze,
                                            streaming=False)
        metrics = _batch(spark, read(schemas.TOPIC_CRANE), read(schemas.TOPIC_GATE_IN),
                         read(schemas.TOPIC_GATE_OUT), a.out)
    elif a.cmd == "demo":
        p = pipeline.from_testdata(spark, a.sf_dir)
        metrics = pipeline.materialize(p, a.out)
    elif a.cmd == "publish":
        from .streaming import pipeline as sp
        metrics = sp.publish_gold(spark, a.out, database=a.database)
    elif a.cmd == "land-schedule":
        from .operators import manifest
        docs = bronze.read_existing_manifests(spark, a.manifests)
        metrics = {} if docs is None else {"landed": sinks.land_schedule(manifest.vessel_schedule(docs), a.out)}
    else:
        from .streaming import pipeline as sp
        opts = dict(kv.split("=", 1) for kv in a.kafka_option)
        src = {kind: bronze.read_bronze(spark, topic, options=opts) for kind, topic in sp.KINDS.items()}
        trigger = {"processingTime": a.trigger}
        queries = sp.bronze_streams(spark, src, a.out, trigger=trigger, database=a.database)
        queries |= sp.silver_streams(spark, sp.bronze_sources(spark, a.out, database=a.database), a.out,
                                     trigger=trigger, database=a.database)
        queries |= sp.gold_streams(spark, a.out, trigger=trigger, database=a.database,
                                   state_partitions=a.state_partitions, salts=a.salts)
        while all(q.isActive for q in queries.values()):
            time.sleep(5)
        for q in queries.values():      # one has ended: stop the rest, raise its error
            if q.isActive:
                q.stop()
            q.awaitTermination()
        return 0
    print(json.dumps({"tables": a.out, "expectations": metrics}, default=str))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
