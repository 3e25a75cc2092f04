"""Structured Streaming: sinks, output modes, triggers, checkpoints, and the three stream jobs."""
