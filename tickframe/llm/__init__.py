"""Operators of a training-data pipeline.

Each module holds one operator; ``queries`` registers one ``opN_<name>``
query per operator together with its DuckDB SQL where SQL can express it.
Nothing outside this folder (and ``corpus_pipeline.py``) imports it.
"""
