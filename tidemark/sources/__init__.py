"""Reading and writing: schemas, envelopes, topics, tables."""
