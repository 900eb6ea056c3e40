"""Command line: the timing report and the neighbourhood search.

    python -m citeweave report --input 'corpus/*.json' [--sample 0.33] [--partitions 4] \
        [--publications 5] [--journals 5] [--print] [--output out/] [--csv out/csv]
    python -m citeweave report --properties application.properties
    python -m citeweave search --input 'corpus/*.json' --graph publication \
        --direction in --name "Exact title" [--name ...] [--output out/]

Reads JSON-lines publication records. Results are written to ``--output``
(JSON folders), reports also to ``--csv``. A search without ``--output`` prints
every neighbour, as does ``--print`` for reports; rows arrive one partition at
a time. ``--show`` prints fewer and says how many there are. ``--properties`` takes a run configuration in
Java properties form (keys below). Use spark-submit to run it on a cluster;
the session's ``spark.checkpoint.dir`` must name a shared folder there.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

# Run-configuration keys understood by --properties, and the
# report option each one sets.
PROPERTY_KEYS = {
    "file.path": "input",
    "sample.size": "sample",
    "repartition.size": "partitions",
    "test.entity.publication": "with_publications",
    "test.entity.journal": "with_journals",
    "test.publication.size": "publications",
    "test.journal.size": "journals",
    "test.print.results": "print",
}


def read_properties(path: str) -> dict[str, str]:
    """key = value lines; '#' and '!' start comments."""
    out = {}
    with open(path, encoding="utf-8") as fh:
        for raw in fh:
            line = raw.strip()
            if not line or line[0] in "#!":
                continue
            sep = min((i for i in (line.find("="), line.find(":")) if i >= 0), default=-1)
            if sep < 0:
                continue
            out[line[:sep].strip()] = line[sep + 1:].strip()
    return out


def _apply_properties(args: argparse.Namespace, props: dict[str, str]) -> None:
    for key, option in PROPERTY_KEYS.items():
        if key not in props:
            continue
        value = props[key]
        if option in ("sample",):
            setattr(args, option, float(value))
        elif option in ("partitions", "publications", "journals"):
            setattr(args, option, int(value))
        elif option in ("with_publications", "with_journals", "print"):
            setattr(args, option, value.lower() == "true")
        else:
            setattr(args, option, value)
    if getattr(args, "with_publications", True) is False:
        args.publications = 0
    if getattr(args, "with_journals", True) is False:
        args.journals = 0


def _session() -> SparkSession:
    spark = SparkSession.builder.appName("citeweave") \
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true").getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def print_rows(df, most: int | None = None) -> None:
    """All rows, tab-separated below their names; with ``most``, so many and the full count."""
    print("\t".join(df.columns))
    for row in (df if most is None else df.limit(most)).toLocalIterator():
        print("\t".join("" if x is None else str(x) for x in row))
    if most is not None:
        print(f"of {df.count()} rows")


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="citeweave")
    sub = p.add_subparsers(dest="cmd", required=True)
    for name in ("report", "search"):
        s = sub.add_parser(name)
        s.add_argument("--input", help="JSON-lines records (path or glob)")
        s.add_argument("--mode", default="FAILFAST", choices=["FAILFAST", "PERMISSIVE", "DROPMALFORMED"])
        s.add_argument("--sample", type=float, default=None, help="fraction of records to keep (by key hash, or by chance with --bernoulli)")
        s.add_argument("--bernoulli", action="store_true", help="sample rows by chance, with a fixed seed")
        s.add_argument("--partitions", type=int, default=None, help="repartition the records after loading")
        s.add_argument("--output", default=None)
        s.add_argument("--show", type=int, default=None, help="print at most so many rows")
    r = sub.choices["report"]
    r.add_argument("--properties", default=None, help="run configuration (Java properties)")
    r.add_argument("--publications", type=int, default=5)
    r.add_argument("--journals", type=int, default=5)
    r.add_argument("--direction", default="in", choices=["in", "out", "either"])
    r.add_argument("--print", action="store_true", help="print the report rows")
    r.add_argument("--csv", default=None, help="write each report as CSV below this folder")
    r.add_argument("--save", default=None, help="save the graphs below this folder, for searches")
    q = sub.choices["search"]
    q.add_argument("--graph-path", default=None, help="search a graph that report --save wrote (its folder), without building one")
    q.add_argument("--graph", default="publication", choices=["publication", "journal"])
    q.add_argument("--direction", default="in", choices=["in", "out", "either"])
    q.add_argument("--name", action="append", required=True)
    args = p.parse_args(argv)
    if args.cmd == "report" and args.properties:
        _apply_properties(args, read_properties(args.properties))
    saved = getattr(args, "graph_path", None)
    if not args.input and not saved:
        p.error("--input (or file.path in --properties, or --graph-path) is required")

    from citeweave.plans.graph import CitationGraph, build_journal_graph, build_publication_graph, load_corpus

    spark = _session()
    pubs = None if saved else load_corpus(spark, args.input, mode=args.mode, sample=args.sample, by_hash=not args.bernoulli,
                                          partitions=args.partitions)
    if args.cmd == "report":
        from citeweave.plans.testmode import run_test_mode
        from citeweave.sources.jsonl import write_csv

        res = run_test_mode(pubs, args.publications, args.journals, args.direction, output=args.output)
        if args.save:
            for kind, graph in res["graphs"].items():
                graph.write(f"{args.save.rstrip('/')}/{kind}")
        print(json.dumps({"seconds": res["seconds"], "rounds": res["rounds"]}))
        if args.print:
            for kind, report in res["reports"].items():
                print(f"{kind}: most influential citing vertices of the top seeds")
                print_rows(report.orderBy("seed_position", "rank"), args.show)
        if args.csv:
            for kind, report in res["reports"].items():
                write_csv(report, f"{args.csv.rstrip('/')}/{kind}_report")
    else:
        build = build_publication_graph if args.graph == "publication" else build_journal_graph
        graph = CitationGraph.read(spark, saved) if saved else build(pubs)
        result = graph.influential(args.name, args.direction)
        if args.output:
            result.write.mode("overwrite").json(args.output)
        else:
            print_rows(result.orderBy("seed_id", "rank"), args.show)
    spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
