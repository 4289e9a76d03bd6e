"""Operators of the inventory, grouped by layer.

clean      raw cells -> clean staged rows (header parsing, cleaning, range rules, P16)
tall       wide <-> tall, annotation, station metadata join (P12-P15, J1, J2, O1)
load       dimension merge/upsert, idempotent fact load, keys, versioned publish (L1-L7)
views      warehouse views (V1-V4)
quality    integrity / quality / coverage reports and shares (A0-A17, J4, J5, W1, W2)
analytics  analytic reports (B1-B12, J8)
profile    staged / normalised layer profiling and set operations (E1-E16, U1-U5)
stats      exact quantiles by distributed sort
"""
