"""Named tables: silver cleansing, gold star schema, marts."""
