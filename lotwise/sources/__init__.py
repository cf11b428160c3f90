"""Readers and writers: key/value text, JSON, lake layout, CSV, JDBC, web pages."""
