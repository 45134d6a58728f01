"""Sinks and write modes: guarded slice loads, swaps, exports, manifests and dated sinks."""
