"""Training-data operators over a corpus of documents."""
