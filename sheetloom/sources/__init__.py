"""Tab-separated tables in and out."""
