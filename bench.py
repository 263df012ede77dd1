"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the local cores, BENCH_RUNS the timed
runs per query (the median is reported, after one warm-up run), BENCH_QUERIES an
optional comma-separated choice.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ticketmill.plans import catalog
from ticketmill.session import local_session

HEADLINES = (
    "redact_documents",
    "redact_english",
    "redact_memo",
    "redact_distinct",
    "redact_machine_names",
    "redact_tickets_custom",
    "redact_json_records",
    "redact_context_scores",
    "mask_known_names",
    "mask_known_names_joined",
    "entity_usage",
    "detector_metrics",
    "json_verdicts",
    "reformat_events",
    "line_integrity",
    "ticket_payload",
    "training_pairs",
    "model_requests",
    "verdict_parse",
    "route_tickets",
    "bad_reasons",
    "word_gate",
    "pack_documents",
    "progress_30s",
    "recent_bad",
    "bad_digest",
    "bad_ratio_ema",
    "failure_streaks",
    "rate_excess",
    "attempt_outcomes",
    "stream_ema",
    "stream_redact",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else HEADLINES
    spark = local_session(
        cores,
        memory=os.environ.get("BENCH_MEMORY", "16g"),
        **{
            "spark.ui.showConsoleProgress": "false",
            # Call-site capture costs more than the rest of building a plan.
            "spark.python.sql.dataFrameDebugging.enabled": "false",
        },
    )
    queries = catalog.queries()

    def once(name: str) -> float:
        begun = time.perf_counter()
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - begun

    seconds: dict[str, float] = {}
    failed: dict[str, str] = {}
    for name in names:
        try:
            once(name)
            seconds[name] = round(statistics.median(once(name) for _ in range(runs)), 3)
        except Exception as error:  # the others are still measured; the exit code tells
            failed[name] = str(error)[:500]
        print(f"{name}: {seconds.get(name, 'failed')}", file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cores": int(cores),
                "runs": runs,
                **({"failed": failed} if failed else {}),
            }
        )
    )
    if failed:
        sys.exit(1)


if __name__ == "__main__":
    main()
