"""Operators and pipeline stages for preparing language-model training text.

Each module holds one operator with its own general interface; ``queries``
registers the thin ``opN_<name>`` queries and ``oracle`` their DuckDB SQL.
Nothing else in the library imports this package.

Conventions shared by all operators:

* a null text counts as the empty text unless the docstring says otherwise;
* rows are never dropped for a null or repeated key: row-local operators work
  row by row, and joins back to rows go through a value both sides share (a
  fingerprint, a digest, a staged row number), not through the document id;
* an operator that appends columns replaces input columns of the same name;
* intermediate tables go to the shared folder (``spark.checkpoint.dir``).
"""
