"""Text knowledge bases on Spark: normalise, sync, chunk, embed, search."""
