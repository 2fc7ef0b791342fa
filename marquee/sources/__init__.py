"""Readers: tab-separated dumps, snapshot logs, reports and catalogues."""
