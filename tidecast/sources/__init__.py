"""Readers, writers and calendar-like side inputs of the panel."""
