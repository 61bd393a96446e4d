"""Part of the triage library."""
