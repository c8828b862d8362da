"""Feed sinks."""
