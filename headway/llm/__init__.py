"""Operators for preparing training text at scale.

One module per operator; ``queries`` registers one query per operator over
the whole ``documents`` or ``pages`` table.  Nothing outside this
subpackage imports it, apart from the guarded hook in ``__spark_entry__``.
"""
