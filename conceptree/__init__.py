"""Browsable clinical concept catalogs, built and counted as Spark jobs.

``sources``    input tables and the compatibility view
``functions``  text rules, row numbering, range matching, generic table changes
``operators``  one function per catalog step, DataFrame(s) in, DataFrame out
``plans``      the steps put together: vocabulary, OMOP and PCORnet catalogs
"""
