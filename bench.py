"""Headline timings at $BENCH_SF_DIR (default /root/testdata/sf0.1) on
local[$BENCH_CPUS]; prints one JSON line.

Steps are timed in the order a user runs them: derive the corpus, build the
publication and journal graphs (edges, degrees, PageRank; the two builds run
concurrently), then the reports on the built graphs. Results are forced with a no-op write, so
nothing is collected to the driver.

Before that, the same steps run once on the smallest test tables (when
present): their seconds are the cold ones, JIT compilation included, and the
timed steps are warm.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


from citeweave.plans import graph as G  # noqa: E402
from citeweave.plans.catalog import QUERIES  # noqa: E402
from citeweave.session import local_session  # noqa: E402

REPORT_K = 500  # seeds per entity in the documented test-mode runs


def run(df):
    df.write.format("noop").mode("overwrite").save()


STEPS = ["publication_summary", "journal_summary", "influential_publications", "influential_journals", "top_publications",
         "neighbors_in", "neighbors_out", "neighbors_either", "dense_publication_index", "dense_journal_index",
         "graph_links", "journal_edges", "unresolved_citations", "scan_publications", "scan_quarantine", "hex_to_decimal"]


def steps(spark, sf_dir: str) -> tuple[dict[str, float], object, object, object]:
    """Seconds of every step, in the order a user runs them."""
    times: dict[str, float] = {}

    def timed(name, fn):
        t = time.perf_counter()
        out = fn()
        times[name] = round(time.perf_counter() - t, 3)
        return out

    pubs = timed("corpus", lambda: G.corpus(spark, sf_dir))
    # Publication and journal graphs (edges, degrees, PageRank), built concurrently.
    pg, jg = timed("graphs", lambda: G.graphs(spark, sf_dir))
    timed("influence_report_publications_k500",
          lambda: run(pg.influence_report(REPORT_K, "in")))
    timed("influence_report_journals_k500",
          lambda: run(jg.influence_report(REPORT_K, "in")))
    for key in STEPS:
        timed(key, lambda k=key: run(QUERIES[k](spark, sf_dir)))
    return times, pubs, pg, jg


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cpus, shuffle_partitions=cpus, app="citeweave-bench", extra={
        "spark.ui.showConsoleProgress": "false",
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="citeweave-bench-"),
    })
    # Cold: the first run of everything, on the smallest tables, compiles the code.
    small = os.path.join(os.path.dirname(sf_dir), "sf0.001")
    cold = {}
    if os.path.isdir(small) and small != sf_dir:
        cold = steps(spark, small)[0]
        G.forget(spark)
    times, pubs, pg, jg = steps(spark, sf_dir)
    n_pubs = pubs.count()
    result = {
        "metric": "citation_graph_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir).replace("sf", ""),
        "cold_smallest_tables": cold,
        "rounds": {"publication": pg.rounds, "journal": jg.rounds},
        "publications": n_pubs,
        "cpus": cpus,
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
