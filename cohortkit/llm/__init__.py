"""Training-data pipeline operators; nothing else in the package imports this subpackage.

Each module is one operator with its own general interface; ``queries`` registers one query per
operator (``opN_<name>``) and the corpus pipeline for the driver contract.
"""
