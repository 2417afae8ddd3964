"""Inputs and outputs: JSON-line and page readers, the fixture adapter over the driver's
test tables, landing operators (quarantine, insert-or-ignore, ids) and table sinks."""
