"""Readers, driver-table adapters and sinks."""
