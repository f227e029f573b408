"""placetide: place-and-year analytics as plain PySpark DataFrame functions.

Everything is a ``Column -> Column`` or ``DataFrame -> DataFrame`` function, so it
composes with ``.transform`` and leaves the physical plan to Catalyst and AQE.
"""
