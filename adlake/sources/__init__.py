"""Reading and writing: landing tables, keyed tables, seeds, envelopes and exports."""
