"""Incremental loading: keyset watermark, batch log, atomic publish, batch loop, backlog mode."""
