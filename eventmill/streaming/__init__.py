"""The same load as a stream."""
