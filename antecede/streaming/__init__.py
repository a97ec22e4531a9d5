"""The load as a stream."""

from antecede.streaming.load import load_stream

__all__ = ["load_stream"]
