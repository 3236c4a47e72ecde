"""The pull side of a sync as a Structured Streaming job."""
