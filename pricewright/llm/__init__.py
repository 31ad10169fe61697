"""Training-data operators: each works on whole tables of documents or vectors."""
