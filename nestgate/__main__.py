"""Command line: ``python -m nestgate <command> ...`` (``--local`` for a local session).

collection  harvest -> enrich -> check -> gate -> output (XML or JSON inputs)
generate    wide nested benchmark rows with planted errors, as Parquet
profile     rows, nulls and list metrics per column of a Parquet table
validate    the wide-object rules at a depth on a Parquet table
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def _session(local: bool) -> SparkSession:
    if local:
        from nestgate.session import local_session

        return local_session()
    return SparkSession.builder.appName("nestgate").getOrCreate()


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    ap = argparse.ArgumentParser(prog="nestgate")
    ap.add_argument("--local", action="store_true", help="run on a local session")
    sub = ap.add_subparsers(dest="cmd", required=True)
    c = sub.add_parser("collection")
    c.add_argument("--out", required=True)
    c.add_argument("--xml-objects")
    c.add_argument("--xml-terms")
    c.add_argument("--json-objects")
    c.add_argument("--json-terms")
    c.add_argument("--multiline", action="store_true", help="JSON files hold one object or array each")
    c.add_argument("--mode", choices=["block", "warn", "quarantine"], default="block")
    c.add_argument("--bulk-index", help="write search-engine bulk pairs for this index")
    g = sub.add_parser("generate")
    g.add_argument("--rows", type=int, default=1_000_000)
    g.add_argument("--errors-per-kind", type=int, default=None)
    g.add_argument("--out", required=True)
    p = sub.add_parser("profile")
    p.add_argument("path")
    p.add_argument("--show", type=int, default=0, help="also print the first N rows as JSON documents")
    v = sub.add_parser("validate")
    v.add_argument("path")
    v.add_argument("--depth", choices=["types", "flat", "full"], default="full")
    args = ap.parse_args(argv)
    spark = spark or _session(args.local)

    if args.cmd == "collection":
        from nestgate.plans.collection import materialize_collection

        out = materialize_collection(spark, args.out, args.xml_objects, args.xml_terms, args.json_objects,
                                     args.json_terms, mode=args.mode, bulk_index=args.bulk_index,
                                     multiline=args.multiline)
        print(json.dumps(out, default=str))
    elif args.cmd == "generate":
        from nestgate.sources import synth as SY

        per_kind = args.errors_per_kind if args.errors_per_kind is not None else args.rows // 20
        ids = spark.range(args.rows).select(F.col("id").alias("n"))
        SY.inject_errors(SY.generate_objects(ids, args.rows), per_kind).drop("n").write.mode("overwrite") \
            .parquet(args.out)
        print(json.dumps({"rows": args.rows, "errors_per_kind": per_kind, "path": args.out}))
    elif args.cmd == "profile":
        from nestgate.plans.profile import table_profile

        from nestgate.plans.export import to_json_document

        df = spark.read.parquet(args.path)
        for r in table_profile(df).collect():
            print(json.dumps(r.asDict()))
        if args.show:  # a sample for display: the limit is the feature here
            for r in df.limit(args.show).select(to_json_document(df).alias("d")).collect():
                print(r["d"])
    elif args.cmd == "validate":
        from nestgate.plans import collection as M
        from nestgate.plans.validate import validate_frame

        rep = validate_frame(spark.read.parquet(args.path), M.WIDE, M.wide_rules(), depth=args.depth)
        print(json.dumps({"passed": rep.passed, "dtype_problems": rep.dtype_problems,
                          "failures": rep.failures()}, default=str))
        return 0 if rep.passed else 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
