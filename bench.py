"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` is the folder of the tables and ``BENCH_CPUS`` the number of
cores.  ``python bench.py name ...`` times the named queries only, ``all`` all.
"""

from __future__ import annotations

import json
import os
import sys
import time

from tunemill.queries import queries
from tunemill.session import get_session

HEADLINE = (
    "training_summary training_labels filter_equals systematic_sample recipe_fanout render_pretrain "
    "render_qa render_context_hint prompt_dispatch chat_render split_exact split_hash eval_cap "
    "truncate_tokens pack_sequences extract_robust score_compare vote_consensus vote_ranking "
    "perplexity_unigram expert_route latest_version elapsed ingest_quarantine"
).split()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="8g",
        spark__ui__enabled="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    known = queries()
    names = sys.argv[1:] or HEADLINE
    names = list(known) if names == ["all"] else names

    def run(name: str) -> float:
        start = time.perf_counter()
        known[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    run(names[0])  # start the executors and load classes
    times = {name: round(run(name), 3) for name in names}
    result = {
        "metric": "total_query_time",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
