"""Operators for preparing training data: duplicates, quality, toxicity, secrets, mixing, chat, pieces."""
