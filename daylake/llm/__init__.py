"""Operators of a training-data pipeline over the tables ``documents``, ``benchmark``,
``labels`` and ``embeddings``.  Nothing else in the library imports this package.

Rules that hold for every operator here:

* A null text is treated as stated in the operator's docstring, never dropped.
* ``doc_id`` may be null or repeated; rows are never matched by it unless said so.
* Only the named columns are read, so further columns of a table may have any name.
* An empty table gives an empty result with the same columns.
* Data is partitioned and shuffled by Spark; tasks work on Arrow batches cut into
  blocks of bounded size.
"""
