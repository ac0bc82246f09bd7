"""Scans and sinks. Paths are always arguments and may be any Hadoop file system URI."""
