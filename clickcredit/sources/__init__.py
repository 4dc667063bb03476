"""Inputs: hit files, driver tables, file listings, and the adapters that derive hits and file records."""
