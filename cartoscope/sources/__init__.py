"""Readers and writers: captured pages, records in HTML, XML and JSON, run files."""
