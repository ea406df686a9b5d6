"""Training-data operators: de-duplication, filters, mixing, packing, token counts, search."""
