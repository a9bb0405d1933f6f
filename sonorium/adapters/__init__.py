"""What reaches outside: network, codecs, recognisers, the hub. Protocols with in-memory stand-ins; no relational logic."""
