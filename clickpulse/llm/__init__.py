"""Training-data operators: deduplication, decontamination, tokens, quality, shards, secrets.

Each module holds one operator with a general interface over any DataFrame that
has an integer id column and a text column; ``queries`` applies them to the
``documents`` table. Nothing outside this folder imports it.
"""
