"""Where results go: files, message topics, search indexes, latest-value tables."""
