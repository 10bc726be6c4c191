"""Passes composed of operators: landing, ingest, discovery."""
