"""Session, shared storage and skew-safe building blocks."""
