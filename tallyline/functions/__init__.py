"""Column helpers: 32-byte words, keys, text and segments."""
