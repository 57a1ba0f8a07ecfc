"""The cohort tables, layer by layer, and the batch pipeline that writes them."""
