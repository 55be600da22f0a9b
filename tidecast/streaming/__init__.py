"""Structured Streaming twins of the panel, the z-score and the streak alert."""
