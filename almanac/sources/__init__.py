"""Readers: catalog, CSV tables, landed downloads, archives."""
