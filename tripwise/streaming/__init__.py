"""Insert-only change capture with file streams and checkpoints."""
