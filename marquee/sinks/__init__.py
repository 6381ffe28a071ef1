"""Text and table outputs."""
