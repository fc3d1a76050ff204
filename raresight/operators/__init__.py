"""Operators, one module per stage: contracts (V), profile (P), prepare (T),
train (M), evaluate (E), monitor (D)."""
