"""Readers for survey exports, trait tables, lookups and the test-table view."""
