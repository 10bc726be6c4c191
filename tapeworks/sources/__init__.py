"""Scans: payload tables and files to typed rows, reference data, label lists."""
