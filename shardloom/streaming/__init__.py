"""Structured Streaming counterparts; each has a batch twin it must agree with."""
