"""Part of chainframe."""
