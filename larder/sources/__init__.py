"""Readers, writers, JDBC tables and catalog tables."""
