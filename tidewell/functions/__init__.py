"""Part of tidewell."""
