"""Developer tools (correctness harness)."""
