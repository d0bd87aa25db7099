"""Streams: an extension, the domain itself is batch only."""
