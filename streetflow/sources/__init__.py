"""Readers: topics, tables, and the files the jobs start from."""
