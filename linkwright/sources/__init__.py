"""Readers and writers: tab-separated sources, id lists, normalized stores, reports."""
