"""phonoloom: a PySpark engine that curates speech-and-text training corpora.

Recordings, transcripts and label files are DataFrames; every operator is a plan built from the
DataFrame/SQL API, with Arrow-batched Python only where no built-in expression has the semantics.
"""

__version__ = "0.1.0"
