"""Running the live measures as streams, and their sinks."""
