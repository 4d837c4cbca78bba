"""Two-sided turn games as tables: protocol logs, perspectives, labels, inference, matrices, texts."""
