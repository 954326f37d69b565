"""Column expressions: row codec, message headers, partition literals."""
