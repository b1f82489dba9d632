"""Text sinks and line formats."""
