"""Structured Streaming: file replay of the event table, update-log sinks, live-clock windows."""
