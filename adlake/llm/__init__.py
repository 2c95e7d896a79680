"""Training-data operators over documents, pages, embeddings and benchmark
items.  Nothing outside this subpackage imports it."""
