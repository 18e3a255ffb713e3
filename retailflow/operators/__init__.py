"""Reusable table operators: lookups, rule tables, ordered scans, group totals, bins, reshapes."""
