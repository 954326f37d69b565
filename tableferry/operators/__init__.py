"""DataFrame-to-DataFrame operators: packing, routing, clearing, upserting, chunking."""
