"""Sources: raw payloads to typed rows."""
