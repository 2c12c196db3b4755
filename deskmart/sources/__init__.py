"""Readers and writers: CSV directories, star tables, the driver-table adapter."""
