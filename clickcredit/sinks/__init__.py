"""Outputs: report TSV (single or partitioned), status log, hit files in the landing format."""
