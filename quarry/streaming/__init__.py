"""Structured Streaming variants of batch operators (the reference itself has
no streams; these let the same profiles run incrementally over arriving
event files)."""
