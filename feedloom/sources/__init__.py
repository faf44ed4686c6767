"""Sources.  Each reads a table or, with ``stream=True``, a stream of the same rows."""
