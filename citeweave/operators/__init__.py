"""Graph operators: vertices and edges, degrees, PageRank, positions and
ranking, neighbourhoods, summaries and task-metric rollups."""
