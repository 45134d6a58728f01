"""Scans and sources: landed files, delimited text, inventories, XML and API pages."""
