"""Reading and writing store tables: the only place, with ``plans``, that touches storage."""
