"""The landing job: sinks, supervision and its command line."""
