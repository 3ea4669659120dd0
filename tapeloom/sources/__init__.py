"""Readers and writers: frames, envelopes, hot store, lake."""
