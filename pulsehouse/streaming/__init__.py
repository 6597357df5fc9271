"""Structured Streaming forms: watermarks, windows, keyed state, sinks."""
