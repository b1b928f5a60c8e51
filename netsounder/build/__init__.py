"""The build engine: declared stages, fingerprints, a ledger and gates."""
