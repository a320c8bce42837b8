"""Command line: upload, ejson, sql, config, configget from standard input; serve; follow."""

from __future__ import annotations

import argparse
import json
import logging
import sys

from pyspark.sql import SparkSession

from . import settings
from .functions.extended_json import encode
from .plans.engine import Engine
from .sources.files import read_lines


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="tidefold")
    parser.add_argument("function", choices=["upload", "ejson", "sql", "config", "configget", "serve", "follow"])
    parser.add_argument("--root")
    parser.add_argument("--settings", type=argparse.FileType())
    parser.add_argument("--mode", choices=["set", "append"], default="set")
    args = parser.parse_args(argv)
    text = args.settings.read() if args.settings else ""
    s = settings.load(text, root=args.root)
    spark = SparkSession.builder.appName("tidefold").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    spark.sparkContext.setLogLevel(s.log_level)
    logging.basicConfig(level=s.log_level, format="%(asctime)s %(levelname)s %(name)s %(message)s")
    engine = Engine.from_settings(spark, text, root=args.root) if s.root else None
    if args.function == "serve":
        from .server import serve

        serve(engine, s.host, s.port).serve_forever()
        return 0
    if engine is None:
        parser.error("--root is required")
    if args.function == "follow":
        from .sources.tail import tail
        from .streaming.follow import Reporter, follow

        reporter = Reporter(s.report_seconds)
        stream = tail(spark, s.patterns, s.max_bytes_per_file)
        query = follow(engine, stream, s.checkpoint or f"{s.root}/_stream", {"processingTime": s.interval}, reporter.add, s.wait_for_config)
        try:
            query.awaitTermination()
        finally:
            reporter.close()
    elif args.function == "upload":
        print(json.dumps(engine.upload(read_lines(sys.stdin)).to_dict()))
    elif args.function == "sql":
        print(encode(engine.sql(sys.stdin.read()).to_dict()))
    elif args.function == "configget":
        print(json.dumps(engine.fetch_config()))
    else:
        request = json.load(sys.stdin)
        if args.function == "ejson":
            print(encode(engine.ejson(request)))
        else:
            print(json.dumps({"version": (engine.publish_config if args.mode == "set" else engine.append_config)(request)}))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
