"""Structured Streaming versions of the reference's resumable jobs: graph building, watermarks, warm-up state."""
