"""Part of the chunkmill engine; see README.md."""
