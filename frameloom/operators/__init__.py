"""DataFrame transforms over scanlines."""
