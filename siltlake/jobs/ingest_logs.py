"""Run the log ingest for a folder of configs until it is stopped.

    spark-submit -m siltlake.jobs.ingest_logs --configs DIR --servers HOST:PORT \\
        --out /lake/logs --checkpoints /lake/checkpoints
"""

from __future__ import annotations

import argparse
import sys
from collections.abc import Callable

from pyspark.sql import SparkSession

from siltlake.session import build_session
from siltlake.streaming.catalog import publish
from siltlake.streaming.ingest import Started, read_configs, run_ingest, stream_source, supervise


def ingest(
    spark: SparkSession, folder: str, out: str, checkpoints: str, once: bool = False, max_offsets: int | None = None,
    report: Callable[[Started], object] | None = None, **source,
) -> list[Started]:
    """Create the configs' tables, start a query per topic and wait; returns how each one went."""
    cfgs, unread = read_configs(folder)
    started = run_ingest(
        spark, cfgs, lambda cfg: stream_source(spark, cfg, max_offsets=max_offsets, **source), out, checkpoints,
        once=once, after=lambda cfg, base: publish(spark, cfg, base),
    )
    return supervise(spark, [*unread, *started], report)


def main() -> None:
    args = argparse.ArgumentParser(description=__doc__)
    args.add_argument("--configs", required=True)
    args.add_argument("--servers", required=True)
    args.add_argument("--out", required=True)
    args.add_argument("--checkpoints", required=True)
    args.add_argument("--once", action="store_true", help="stop when all present messages are read")
    args.add_argument("--max-offsets", type=int, help="messages per topic and micro-batch")
    given = args.parse_args()
    done = ingest(
        build_session("ingest-logs"), given.configs, given.out, given.checkpoints, given.once, given.max_offsets,
        report=lambda s: print(f"{s.name} failed: {s.error}", file=sys.stderr, flush=True),
        servers=given.servers,
    )
    for s in done:
        print(f"{s.name}: {s.error or 'ended'}")
    sys.exit(any(s.failed for s in done))


if __name__ == "__main__":
    main()
