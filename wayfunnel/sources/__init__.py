"""Readers and writers: raw tables, warehouse tables, exports, shared work area."""
