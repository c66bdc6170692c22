"""Guard for streaming input."""
