"""Landed vendor payloads -> typed rows, with per-payload quarantine."""
