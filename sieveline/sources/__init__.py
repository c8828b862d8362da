"""Feed sources."""
