"""Gridded climate series on Spark: delta-method refinement and derived products."""

from climgrid.grid import Grid

__all__ = ["Grid"]
