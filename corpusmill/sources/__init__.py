"""Listing, reading and writing datasets by URI of any file system Spark knows."""
