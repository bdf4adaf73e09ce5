"""Readers: delimited files, JSON documents, captures, sitemaps and web archives."""
