from .csv import bind_positions, read_csv, read_csv_checked, write_csv
from .dictionary import read_dictionary, read_dictionary_table, write_dictionary, write_dictionary_table
from .sinks import read_runs, write_run, write_table
from .tables import (
    SENTIMENT_CLASSES,
    labelled_conversations,
    labelled_documents,
    read_table,
)

__all__ = [
    "SENTIMENT_CLASSES",
    "bind_positions",
    "labelled_conversations",
    "labelled_documents",
    "read_csv",
    "read_csv_checked",
    "read_dictionary",
    "read_dictionary_table",
    "read_runs",
    "read_table",
    "write_csv",
    "write_dictionary",
    "write_dictionary_table",
    "write_run",
    "write_table",
]
