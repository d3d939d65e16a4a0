"""Readers for landed files and writers for warehouse tables."""
