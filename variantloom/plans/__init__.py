"""Whole jobs, the bridge from generic tables to genomic inputs, and the registered queries."""
