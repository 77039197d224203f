"""Streaming: incremental monthly country counts from landing files."""

from .incremental import compact_partials, counts_from_partials, read_partials, start_count_stream

__all__ = ["compact_partials", "counts_from_partials", "read_partials", "start_count_stream"]
