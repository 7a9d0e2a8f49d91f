"""Scans: manifests, grids, workbooks, pages, keys and configurations."""
