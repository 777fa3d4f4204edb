"""Whole plans: the incremental analytics run and the read views."""
