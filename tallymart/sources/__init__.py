"""Table sources, canonical schema and shared intermediate storage."""
