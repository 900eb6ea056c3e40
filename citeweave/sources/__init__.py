"""Inputs and outputs: the publication record schema, JSON-lines scan and
quarantine, sampling, sinks, and the corpus derived
from the test tables."""
