"""Training-data operators: fingerprints, quality, joins, privacy, packing, mixing, archives, scoring, licences, token shards."""
