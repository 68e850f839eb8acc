"""Readers of landed feed documents and the record store (SRC1-SRC12),
and the store / export sinks (SNK1-SNK7)."""
