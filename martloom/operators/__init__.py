"""DataFrame operators of an incremental load (each usable on its own)."""
