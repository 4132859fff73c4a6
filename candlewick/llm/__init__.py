"""Training-data operators: dedup, decontamination, classifiers, packing, archives.

Nothing else in the library imports this subpackage; ``__spark_entry__.py``
registers its queries when it is present.
"""
