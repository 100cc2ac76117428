"""Training-data operators: tokens, chat windows, deduplication, similarity, toxicity and mixing."""
