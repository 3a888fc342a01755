"""Sources and sinks: text lines, CSV, repeatable sampling and splitting."""

from sparkfit.sources.csv import read_csv, read_csv_inferred, write_csv
from sparkfit.sources.records import csv_records
from sparkfit.sources.sampling import hash_split, sample_exact, sample_key
from sparkfit.sources.text import read_lines, write_lines

__all__ = ["read_lines", "write_lines", "read_csv", "read_csv_inferred", "csv_records", "write_csv",
           "sample_exact", "sample_key", "hash_split"]
