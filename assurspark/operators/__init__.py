"""Operators beyond a plain DataFrame call: size-checked broadcasts, OR-join and
interval-join rewrites, null-aware NOT IN, hot-key salting (joins); top-1 per
key and conditional aggregates (aggregates); rate-at-date lookups and currency
conversion (currency)."""
