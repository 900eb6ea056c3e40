"""Write PLANS.md: physical plans of the main operators at a given scale.

    python tools/plans.py /root/testdata/sf0.1 > PLANS.md
"""

from __future__ import annotations

import contextlib
import io
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from citeweave.operators import edges as E  # noqa: E402
from citeweave.operators import pagerank as pm  # noqa: E402
from citeweave.operators.indexing import dense_index  # noqa: E402
from citeweave.plans import graph as G  # noqa: E402
from citeweave.session import keep, local_session  # noqa: E402
from citeweave.sources.corpus import derived_corpus  # noqa: E402


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue().strip()


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(8, extra={"spark.ui.showConsoleProgress": "false"})
    pubs = G.corpus(spark, sf)
    # The loop's plans are those of this very build.
    seen: dict[str, str] = {}

    def watched(name):
        original = getattr(pm, name)

        def call(*args, **kwargs):
            df = original(*args, **kwargs)
            seen.setdefault(name, plan(df))
            return df
        setattr(pm, name, call)

    watched("edge_layout")
    watched("_messages")
    watched("_first_state")
    watched("_folded")
    pg = G.publication_graph(spark, sf)
    jg = G.journal_graph(spark, sf)
    out = [f"# Physical plans ({os.path.basename(sf)}, local[8], AQE on outside the PageRank loop)\n",
           "Generated by `python tools/plans.py`. Initial (pre-AQE) plans; AQE may later turn a shuffle join",
           "into a broadcast join or coalesce partitions from runtime sizes.\n"]

    def section(title, note, df):
        out.append(f"## {title}\n\n{note}\n\n```\n{df if isinstance(df, str) else plan(df)}\n```\n")

    section("Derived corpus", "The next line of an order comes from global positions and an equi-join on position, "
            "whatever an order's size; one record for each part and order.", derived_corpus(spark, sf))
    section("Publication vertices", "Kept tables are Parquet: the scan reads two columns.", E.publication_vertices(pubs))
    vertices = keep(dense_index(E.publication_vertices(pubs), ["id"], name="node"), "plan-keys")
    section("Citations resolved to surrogate ids", "The source id is attached per reference list before the "
            "expansion; the expanded rows take part in one join, the resolution itself. Identical "
            "(id, list) records collapse with map-side partial de-duplication before their shuffle.",
            E.publication_edges_keyed(pubs, vertices))
    section("Journal edges", "Partial and final aggregation of (source journal, target journal).",
            E.journal_edges(pubs))
    section("PageRank edge layout", "Runs in the loop's own session (AQE off, P shuffle partitions). Parallel "
            "edges are folded with map-side partial aggregation before their shuffle (copies of a pair "
            "collapse first); the folded pairs are then partitioned on the source; out-degrees are joined "
            "on the same key with a hash join built on the degree side, so the edge rows are never sorted.",
            seen["edge_layout"])
    section("One PageRank round", "Deltas and edge layout share the hash partitioning on the source: the "
            "join has no exchange on either side (the layout is read from the executors' cache). The only "
            "shuffle is the message sum, after partial aggregation.", seen["_messages"])
    section("First state", "Round one needs no join: every vertex sends the same value. The same sum counts "
            "in-edges; out-edges come from the layout.", seen["_first_state"])
    section("A fold", "Deltas of many rounds are joined to the state partition by partition; no exchange.", seen["_folded"])
    section("Neighbours of the five highest-ranked vertices", "A range on the sorted seed column, two bigint columns "
            "scanned, no edge shuffled.", pg.top_neighbors(5, "either"))
    section("Influential neighbours by name", "Names times the most vertices sharing one bound the seeds, so they are "
            "broadcast.", pg.influential(["some title"], "in"))
    section("Node-link export", "A projection of stored node numbers.", pg.node_link()[1])
    section("Batch influence report (k = 500)", "Seeds are a filter on the stored position. Neighbours are ranked "
            "inside (seed, slot of 100,000 positions), so no seed is sorted by one task; the slot sizes reuse "
            "the ranked rows' exchange.", pg.influence_report(500))
    section("Publication summary", "One pass over the attributed vertices.", pg.summary())
    section("Highest-degree vertices", "A global aggregate with partial aggregation; nothing is sorted.",
            jg.max_degree())
    print("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
