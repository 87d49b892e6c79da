"""Catalog, ledger, and the registered queries."""
