"""Readers, vocabulary seeds, the binding of the driver tables, and sinks."""

from stayflow.sources.tables import read_table  # noqa: F401
from stayflow.sources.seeds import load_vocabulary, vocabulary_values  # noqa: F401
