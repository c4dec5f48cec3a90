"""Compositions: enrichment, stages and the registered queries."""
