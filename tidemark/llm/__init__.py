"""Operators of a training-data pipeline: each module is one operator with its
own general interface; :mod:`tidemark.llm.queries` holds the registered queries."""
