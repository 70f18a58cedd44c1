"""Readers of series, baselines, point text and ASCII grids; catalog; writers."""
