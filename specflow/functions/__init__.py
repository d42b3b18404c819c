"""Column-level helpers: text, JSON text and prompts."""
