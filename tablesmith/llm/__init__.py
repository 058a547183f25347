"""Training-data operators (numbered 1 to 10) and their queries.

Nothing outside this subpackage imports it, except the guarded registration in
``__spark_entry__.py``.
"""
