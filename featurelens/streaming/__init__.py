"""Streaming use of the encoders.

The operators here have no streaming-only semantics (no watermarks or state):
scoring a stream is a stream-static join of the saved maps, so the batch
functions are reused on a streaming DataFrame.
"""

from featurelens.streaming.scoring import score_stream

__all__ = ["score_stream"]
