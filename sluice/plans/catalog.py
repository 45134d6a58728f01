"""Imports every query module so that the registry is complete."""

from . import flagship, q_exports, q_files, q_misc, q_records, q_reports, q_sync  # noqa: F401
