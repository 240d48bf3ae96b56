"""Tables, reports, feature lists and fitted objects: reading and writing."""
