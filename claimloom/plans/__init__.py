"""The four output tables, composed from operators."""
