"""Relational building blocks and distributed data-quality operators."""
