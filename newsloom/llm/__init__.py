"""Operators of a training-data pipeline: each is a job over whole tables of documents, pages or vectors."""
