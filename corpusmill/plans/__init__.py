"""Queries by family, each with its DuckDB SQL; catalogue.py puts them together."""
