"""Readers and writers: ledgers, releases, direct files, paged sources."""
