"""Composite jobs: operators wired from sources to sinks."""
