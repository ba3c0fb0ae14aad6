"""Streams.

There is no streaming operator of its own here: the column functions in :mod:`corpusgate.functions` are row-local, so
they apply to a ``readStream`` DataFrame as they are (``tests/test_units.py`` runs one).  Jobs with joins or windows
need a whole document and stay batch jobs.
"""
