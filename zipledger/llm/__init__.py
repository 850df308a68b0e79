"""Training-data operators: ten operators over documents, conversations and benchmark items."""
