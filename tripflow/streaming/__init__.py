"""Streaming runs and sinks. Runs take the messages there are (``availableNow``) unless told otherwise."""
