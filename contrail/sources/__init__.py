"""Readers, writers and the driver-table views."""
