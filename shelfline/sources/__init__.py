"""Readers for landed pages, internal sales, market data, layer tables and topics."""
