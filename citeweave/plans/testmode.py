"""The timing run over a corpus: build both graphs (concurrently), take each
graph's k highest-ranked vertices and rank the vertices citing each of them,
reporting seconds per step.

Instead of one lookup job per seed, each report is one distributed job over
all k seeds.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame

from citeweave.plans.graph import build_graphs, build_journal_graph, build_publication_graph
from citeweave.session import keep


def run_test_mode(pubs: DataFrame, publications_k: int = 5, journals_k: int = 5, direction: str = "in",
                  output: str | None = None) -> dict:
    """Returns {"seconds": {...}, "rounds": {...}, "reports": {...}, "graphs": {...}}.

    Both graphs are built concurrently when both are asked for. Each report is
    computed once, into a table in the shared folder, and never collected; whoever
    prints it or writes it elsewhere reads that table. With ``output``, it is
    written as JSON under output/<name>.
    """
    seconds, rounds, reports = {}, {}, {}

    t = time.perf_counter()
    if publications_k and journals_k:
        built = dict(zip(("publications", "journals"), build_graphs(pubs)))
    elif publications_k:
        built = {"publications": build_publication_graph(pubs)}
    elif journals_k:
        built = {"journals": build_journal_graph(pubs)}
    else:
        built = {}
    seconds["graphs"] = time.perf_counter() - t

    for kind, k in (("publications", publications_k), ("journals", journals_k)):
        if not k:
            continue
        graph = built[kind]
        rounds[kind] = graph.rounds
        t = time.perf_counter()
        reports[kind] = keep(graph.influence_report(k, direction), f"{kind}-report")
        seconds[f"{kind}_report"] = time.perf_counter() - t
        if output:
            reports[kind].write.mode("overwrite").json(f"{output.rstrip('/')}/{kind}_report")

    return {"seconds": seconds, "rounds": rounds, "reports": reports, "graphs": built}
