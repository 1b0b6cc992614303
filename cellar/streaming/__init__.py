"""Structured Streaming: the message forwarder (T1-T6) and its sources and sinks."""
