"""Composed plans: bronze builds, silver projections, gold fact, daily job."""
