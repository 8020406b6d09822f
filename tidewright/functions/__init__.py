"""Part of tidewright."""
