"""Readers and writers: CSV inputs, date-partitioned tables, keyed tables, reports."""
