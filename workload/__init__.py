"""The registered queries: the operators run over the order tables, and the same in plain SQL."""
