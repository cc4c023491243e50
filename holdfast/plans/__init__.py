"""Whole jobs: staging, labelling, and the registered queries."""
