"""citeweave: scholarly link graphs on Spark DataFrames.

Reads publication records, derives a paper-to-paper citation graph and a
journal-to-journal graph, attaches degrees and tolerance-based PageRank, and
answers ranked-neighbourhood questions, all as distributed DataFrame jobs.
"""

from citeweave.plans.graph import CitationGraph, build_journal_graph, build_publication_graph, load_corpus

__all__ = ["CitationGraph", "build_publication_graph", "build_journal_graph", "load_corpus"]
