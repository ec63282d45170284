"""Scans: tables, file listings, page images, bundles split into pages."""
