"""Readers: pack files, sheets of workbooks and CSV files, members of ZIP archives."""
