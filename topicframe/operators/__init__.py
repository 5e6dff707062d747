"""Topic operators: offsets and ranges, decoders, encoders, registry, ledger."""
