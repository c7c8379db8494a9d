"""End-to-end batch stages composed from the operators."""
