"""Training-data operators: text quality, deduplication, language, tokens, chat."""
