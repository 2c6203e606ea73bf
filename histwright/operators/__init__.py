"""Operators: pure ``DataFrame -> DataFrame`` functions.

``dims_type1`` (insert new keys), ``dims_type2`` (history: single pass and step by
step), ``dims_late`` (a snapshot that comes after later ones), ``facts`` (append all / new ids), ``meta`` (load watermark), ``reports``
(type-1 and type-2 fraud reports).
"""
