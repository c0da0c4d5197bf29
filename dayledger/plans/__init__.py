"""Whole jobs: loading reports and reading the mart."""
