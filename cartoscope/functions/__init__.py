"""Column functions: text classification, years, ciphers, languages, URLs."""
