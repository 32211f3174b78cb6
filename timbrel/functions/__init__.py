"""Column expressions: names, errors, answer parsing, chats, waveforms."""
