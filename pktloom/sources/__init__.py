"""Readers and writers of captures, packet text, configurations, flow tables and shards."""
