"""Column-level rules: rounding, calendar, SLA, priority."""
